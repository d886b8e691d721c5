"""Readers: job specs, raw delimited text and dimension files."""
