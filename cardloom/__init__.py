"""Bank-card fraud analytics as PySpark jobs."""
