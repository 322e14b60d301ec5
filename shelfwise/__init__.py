"""Retail analytics on Spark: load, profile, clean, consolidate, analyse."""

__version__ = "0.1.0"
