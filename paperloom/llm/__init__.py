"""Operators that prepare training data from large text collections."""
