"""Spark-native analytics and modelling for large birth-registration data."""
