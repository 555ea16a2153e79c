"""Reusable relational operators: ranks, first rows, link measures, integrity."""
