"""Column helpers: every function takes and returns Spark columns."""
