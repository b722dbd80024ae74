"""Whole jobs, and the catalogue of queries over the star tables."""
