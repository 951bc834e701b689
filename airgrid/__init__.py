"""Spark jobs that build and check a historical base of television listings."""
