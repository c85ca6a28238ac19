"""Pipelines and the catalogue of runnable queries."""
