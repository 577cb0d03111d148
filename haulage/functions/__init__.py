"""Column-level building blocks: type mapping, text rendering, elapsed time."""
