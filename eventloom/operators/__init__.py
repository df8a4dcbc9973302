"""Relational operators over event streams and tables (DataFrame → DataFrame)."""
