"""Trip-record analytics and fare regression as plain functions over Spark DataFrames."""
