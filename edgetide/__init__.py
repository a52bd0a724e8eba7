"""edgetide: ranking and exploring large directed link graphs with Spark DataFrames."""
