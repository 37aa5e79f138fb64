"""tidemark: monitoring and time-series preparation on Spark DataFrames."""
