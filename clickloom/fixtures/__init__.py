"""Clickstream input derived from an ``events`` table, for checks and benchmarks."""
