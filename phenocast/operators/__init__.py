"""Operators: each a function DataFrame -> DataFrame with column names as arguments."""
