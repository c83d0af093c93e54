"""Threadline: code lineage for large SAS program collections, as Spark jobs."""
