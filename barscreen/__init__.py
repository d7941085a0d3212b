"""barscreen: bar features, pattern screens and event studies as Spark DataFrames."""
