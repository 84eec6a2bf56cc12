"""Relational operators and composite jobs, each a DataFrame -> DataFrame function."""
