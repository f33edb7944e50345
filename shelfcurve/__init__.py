"""Price elasticity and baseline sales on Spark DataFrames."""
