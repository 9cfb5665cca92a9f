"""Column-level building blocks. Everything here is built-in expressions; no Python UDF."""
