"""Siftwell: curation of large vector and file collections on Spark DataFrames."""

__version__ = "0.1.0"
