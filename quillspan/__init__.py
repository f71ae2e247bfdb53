"""Coverage and interval analytics, expressed as Spark DataFrames."""
