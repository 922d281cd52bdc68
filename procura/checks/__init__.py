"""Independent DuckDB oracle for the registered queries (test side only)."""
