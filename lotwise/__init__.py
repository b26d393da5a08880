"""lotwise: lot-variance analytics on Spark DataFrames."""
