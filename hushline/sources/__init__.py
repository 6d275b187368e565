"""Reading transcripts and writing results."""
