"""Scalar functions: wikitext parsing and Column expressions."""
