"""Loaders, merges, partition replacement, quality checks, run log, lookups, export."""
