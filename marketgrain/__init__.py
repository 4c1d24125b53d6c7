"""Retail demand and price analytics as Spark DataFrame jobs."""
