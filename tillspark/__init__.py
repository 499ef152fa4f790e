"""Retail analytics operators as Spark DataFrame plans."""
