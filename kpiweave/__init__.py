"""Product-analytics KPIs on Spark: DataFrames in, DataFrames out, nothing collected."""
