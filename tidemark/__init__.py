"""Medallion analytics on Spark: ingest, clean, check and aggregate e-commerce tables."""

__version__ = "0.1.0"
