"""Column functions: each takes and returns Spark columns and needs no shuffle."""
