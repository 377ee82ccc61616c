"""Spark-native medallion lakehouse: raw JSON to cleaned tables, aggregates, features and models."""

__version__ = "0.1.0"
