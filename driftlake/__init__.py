"""Change, history and movement analytics over Spark DataFrames."""
