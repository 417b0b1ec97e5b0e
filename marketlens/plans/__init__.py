"""Business models, reports and analytical questions as Spark plans."""
