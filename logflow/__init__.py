"""logflow: analytics on keyed, partitioned record logs with Spark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
