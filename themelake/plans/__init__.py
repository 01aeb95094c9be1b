"""Composite jobs, registered queries and their SQL."""
