"""Relational operators over bronze, silver and gold tables."""
