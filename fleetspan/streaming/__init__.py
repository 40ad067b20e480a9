"""Structured Streaming forms of the serving reports."""
