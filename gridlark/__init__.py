"""Spark-native analytics for georeferenced point-sample sensor data."""
