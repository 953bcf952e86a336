"""Clickstream analytics as Spark DataFrame functions.

Raw click events are read, deduplicated, cleaned, enriched, aggregated and written
out, every step a plain ``DataFrame -> DataFrame`` function for ``df.transform``.
The package never creates a session; it uses the one it is given.
"""
