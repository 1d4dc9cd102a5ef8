"""Reusable dataset operators: dedup, upsert, quality counts."""
