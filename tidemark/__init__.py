"""Change-data star schema on Spark: landing, type-2 dimensions, facts."""
