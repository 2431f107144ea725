"""Spark-first text analytics."""
