"""Incremental runs over a growing record directory."""
