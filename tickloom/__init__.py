"""Forecast-feature and label-data jobs written as Spark DataFrame plans."""
