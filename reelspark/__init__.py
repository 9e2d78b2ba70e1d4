"""Spark-native analytics for film, clip, transcript and face-track datasets."""
