"""Compositions of operators: end-to-end plans and the query catalogue."""
