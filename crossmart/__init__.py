"""Cross-market price analytics on Spark DataFrames."""
