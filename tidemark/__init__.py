"""Point-in-time analytics over entity tables and event logs, on Spark DataFrames."""
