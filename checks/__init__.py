"""Queries and SQL that check the library over the given tables."""
