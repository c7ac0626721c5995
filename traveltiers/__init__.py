"""Tiered (raw -> cleaned -> aggregated -> validated) travel purchase analytics on PySpark."""

__version__ = "0.1.0"
