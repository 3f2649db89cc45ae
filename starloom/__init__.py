"""Star-schema ETL and analytics on Spark DataFrames."""
