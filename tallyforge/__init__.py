"""Spark-native prediction-market analytics and training-data preparation."""
