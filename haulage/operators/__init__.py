"""Frame-level operators: extraction, profiling and publishing."""
