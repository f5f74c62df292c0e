"""Milk laboratory result reporting as Spark DataFrame jobs."""
