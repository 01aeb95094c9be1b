"""Spark operators and batch jobs for themed open data."""
