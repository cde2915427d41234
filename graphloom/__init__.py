"""Graphloom: a PySpark-native analytics engine for captured graph metadata."""

__version__ = "0.1.0"
