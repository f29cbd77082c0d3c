"""Composed jobs, fixtures over the driver tables, and the query registry."""
