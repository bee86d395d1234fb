"""Test-table adapters, the query registry and the DuckDB oracle for it."""
