"""Lakehouse ingestion operators expressed as Spark DataFrame and streaming plans."""

__version__ = "0.1.0"
