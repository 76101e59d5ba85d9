"""Spark-native entity master, provenance and corpus operators."""
