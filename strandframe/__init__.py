"""Spark-native tables for variants, intervals and reads."""
