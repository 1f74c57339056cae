"""Document structuring and corpus operators on Spark DataFrames."""
