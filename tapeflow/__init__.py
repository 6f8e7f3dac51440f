"""Market-stream analytics on Spark DataFrames."""
