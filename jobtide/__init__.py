"""Job-posting analytics as Spark DataFrames."""
