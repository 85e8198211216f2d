"""kindred: probabilistic record linkage and register analytics on Spark DataFrames."""
