"""Queries and pipelines that compose the operators."""
