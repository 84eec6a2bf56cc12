"""Registries: named builders (K11), registered queries and their DuckDB oracle SQL."""
