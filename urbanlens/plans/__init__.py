"""Composite jobs and the query catalogue."""
