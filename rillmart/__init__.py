"""Spark-native commerce warehouse: operators, sources, sinks and ready-made jobs."""

__version__ = "0.1.0"
