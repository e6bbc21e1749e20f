"""Pitch-level baseball tracking data on Spark: tables, loads, analyses and checks."""

__version__ = "0.1.0"
