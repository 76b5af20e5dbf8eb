"""Spark-native analytics for streams of keyed station snapshots."""
