"""Registered queries over the driver tables, each paired with a DuckDB oracle statement."""
