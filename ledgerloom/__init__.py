"""Retail cleaning, quarantine and star-schema analytics as PySpark jobs."""
