"""DataFrame operators: cleaning, metrics and quality checks."""
