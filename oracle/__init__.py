"""Independent DuckDB statements the registered questions are checked against."""
