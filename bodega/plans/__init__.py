"""Datasets as logical plans: silver, gold, reports and the full pipeline."""
