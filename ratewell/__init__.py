"""Population-health indicator analytics as Spark DataFrame plans."""
