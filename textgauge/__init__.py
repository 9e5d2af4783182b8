"""Text evaluation and retrieval on Spark DataFrames."""
