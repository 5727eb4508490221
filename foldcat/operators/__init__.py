"""Relational operators on the catalogue, each DataFrame in, DataFrame out."""
