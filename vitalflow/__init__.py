"""Spark-native clinical record analytics: layers, events, patient state, features and risk models."""

__version__ = "0.1.0"
