"""Marts and published queries."""
