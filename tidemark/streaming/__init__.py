"""Structured Streaming jobs: landing change records, keeping a current table up to date."""
