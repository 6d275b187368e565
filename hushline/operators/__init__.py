"""Operators on turns and transcripts."""
