"""Page-impression analytics on Spark."""
