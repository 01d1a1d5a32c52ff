"""DataFrame operators: staging, skew-safe windows, intermediate, dimensions,
facts, data quality and feedback extraction."""
