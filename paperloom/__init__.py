"""Scholarly-metadata analytics expressed as Spark DataFrame plans."""
