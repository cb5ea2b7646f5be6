"""Spark-native analytics over gridded forecasts, observations and hazard feeds."""
