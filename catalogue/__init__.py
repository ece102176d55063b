"""One query per operator over the test tables, and its DuckDB equivalent."""
