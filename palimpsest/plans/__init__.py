"""Composite plans: report queries, the build, maintenance, and the registered queries."""
