"""Flow configurations and the records that pass through them, as Spark DataFrames."""
