"""Incremental form of the parse stage."""
