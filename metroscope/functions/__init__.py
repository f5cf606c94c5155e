"""Column-level building blocks: each function takes and returns columns."""
