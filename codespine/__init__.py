"""Hierarchical, versioned code lists on Spark: ingest, normalise, consolidate, validate, query, release."""
