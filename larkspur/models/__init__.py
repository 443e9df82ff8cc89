"""Feature preparation and models on Spark ML."""
