"""Test data, registered queries and their DuckDB twins."""
