"""Machine telemetry and maintenance analytics on Spark DataFrames."""
