"""Spark-native data operators and jobs for subscription commerce."""
