"""Spark-native entity resolution and analytics over heterogeneous site records."""
