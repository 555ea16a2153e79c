"""Curated tables, analytical views, quality checks and exploration queries."""
