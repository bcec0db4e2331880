"""Trait-table harmonisation on Spark: long attribute records in, wide analysis tables and profiles out."""

__version__ = "0.1.0"
