"""Real-time marketing and cart analytics on Spark DataFrames and Structured Streaming."""
