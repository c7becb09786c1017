"""Table builders, the end-to-end load and the query catalog."""
