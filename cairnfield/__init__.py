"""Spark-native location master-data and entity-resolution engine."""
