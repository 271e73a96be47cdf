"""Monthly metric anomaly analytics and training-data operators on Spark."""
