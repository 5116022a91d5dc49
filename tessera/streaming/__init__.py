"""Structured Streaming front end for the incremental silver load."""
