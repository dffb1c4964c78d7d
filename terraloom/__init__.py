"""Spark-native analytics for gridded Earth observations."""
