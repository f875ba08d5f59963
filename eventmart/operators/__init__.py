"""Relational operators of the pipeline, each DataFrame → DataFrame."""
