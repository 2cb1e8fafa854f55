"""Composed workflows and the query catalogue."""
