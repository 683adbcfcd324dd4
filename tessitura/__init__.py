"""Spark-native analytics over timed, speaker-attributed transcripts."""
