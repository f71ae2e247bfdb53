"""Functions of the coverage and interval engine."""
