"""Whole plans: the migration run and the queries over the given tables."""
