"""Spark-native text and clickstream analytics built from DataFrame operators."""
