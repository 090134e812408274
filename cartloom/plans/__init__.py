"""Whole jobs: the full refresh, its outputs, and SQL access to them."""
