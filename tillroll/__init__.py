"""Retail analytics over invoice lines, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
