"""Spark-native record linkage, land-cover and observation analytics."""
