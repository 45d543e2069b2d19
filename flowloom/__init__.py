"""Spark-native engine for life-cycle-assessment data."""
