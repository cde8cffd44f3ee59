"""Feature preparation, model fits on Spark ML, scoring and model versions."""
