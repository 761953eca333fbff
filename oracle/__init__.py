"""DuckDB statements the results are checked against."""
