"""Whole runs, put together from operators, readers and writers."""
