"""Binding of the supplied test tables, the registered queries and their DuckDB oracles."""
