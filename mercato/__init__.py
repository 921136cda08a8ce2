"""mercato: e-commerce analytics as PySpark jobs."""
