"""barline: market time-series analytics as Spark jobs."""
