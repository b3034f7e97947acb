"""Whole plans: how the operators combine into facts, views, checks and snapshots."""
