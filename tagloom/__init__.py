"""Customer tagging on Spark: every tag is a DataFrame-in, DataFrame-out function."""
