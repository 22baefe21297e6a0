"""Column functions: each takes and returns a Spark ``Column``."""
