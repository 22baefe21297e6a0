"""Table operations: each takes and returns a Spark ``DataFrame``."""
