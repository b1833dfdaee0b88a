"""tidepool: Spark-native batch analytics, skew and layout diagnostics, a versioned Parquet
table, and a Structured Streaming medallion pipeline with monitoring."""

__version__ = "0.1.0"
