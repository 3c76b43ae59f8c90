"""Compositions of the operators: the trip star schema and its queries."""
