"""Retail demand features, training and forecasting as Spark DataFrame jobs."""
