"""Size classification with Spark ML."""
