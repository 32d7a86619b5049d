"""Readers for files, databases and streams. Paths and credentials come from the caller."""
