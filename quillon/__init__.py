"""Spark-native engine for building and evaluating question-answer data."""
