"""Dataset input, output and conversion on Spark."""
