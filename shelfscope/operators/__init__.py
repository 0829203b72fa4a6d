"""DataFrame -> DataFrame operators: dedup, cleaning, dimension, facts, marts,
analytics, data quality, top-k."""
