"""hailstat: ride-hailing analytics on Spark DataFrames and Structured Streaming."""
