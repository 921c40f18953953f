"""A three-layer analytics lake for metered trips, written for Spark DataFrames."""
