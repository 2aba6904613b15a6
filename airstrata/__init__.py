"""airstrata: layered environmental-measurement processing on Spark DataFrames."""
