"""Price-bar analytics on Spark DataFrames."""
