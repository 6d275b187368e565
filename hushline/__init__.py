"""Finding, redacting and auditing personal data in call transcripts, on Spark."""

__version__ = "0.1.0"
