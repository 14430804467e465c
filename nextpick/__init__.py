"""Next-product recommendation data on Spark DataFrames."""
