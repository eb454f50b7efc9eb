"""Land-cover map series as Spark DataFrames."""
