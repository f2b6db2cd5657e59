"""Rental and billing analytics expressed as Spark DataFrame jobs."""
