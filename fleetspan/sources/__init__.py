"""Readers for text files, tables and pages."""
