"""Relational operators over case and area tables."""
