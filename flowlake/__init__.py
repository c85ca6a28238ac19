"""Labelled network-flow tables on Spark: ingest, clean, enrich, profile, train, monitor."""
