"""DuckDB oracle: SQL mirror of the binding and models, plus a comparer."""
