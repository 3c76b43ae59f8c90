"""Scans and sources: driver tables, trip feeds, lookups, series, files."""
