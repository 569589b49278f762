"""Market-tape analytics on Spark."""
