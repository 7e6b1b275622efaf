"""Spark-native interval and event analytics."""
