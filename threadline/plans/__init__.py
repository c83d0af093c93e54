"""Shared job plumbing: durable intermediate tables, skewed joins, stage runs."""
