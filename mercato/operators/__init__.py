"""General DataFrame operators the business questions are built from."""
