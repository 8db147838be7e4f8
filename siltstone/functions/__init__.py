"""Column functions, and Arrow-batched functions for formats that Spark has no built-in for."""
