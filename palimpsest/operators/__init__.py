"""Operators on staged and served tables: derive, deduplicate, key, merge, follow."""
