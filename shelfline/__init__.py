"""Retail plan/fact analytics expressed as PySpark DataFrame plans."""
