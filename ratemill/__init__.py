"""Rating analytics as plain functions from Spark DataFrames to Spark DataFrames."""
