"""Cleaning, validation and audit steps: DataFrames in, DataFrames out."""
