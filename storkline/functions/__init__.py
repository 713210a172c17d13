"""Reusable column expressions and DataFrame building blocks."""
