"""Column expressions; all built-in, none a UDF."""
