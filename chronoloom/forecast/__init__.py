"""Forecasters whose fitted state is a table with one row per series."""
