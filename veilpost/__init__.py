"""Screening of large mail collections on Spark: mask, parse, retrieve, score, audit, measure."""

__version__ = "0.1.0"
