"""Column helpers: every one takes and returns Spark columns."""
