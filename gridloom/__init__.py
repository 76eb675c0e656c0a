"""Record, panel and corpus analytics as PySpark DataFrame jobs."""
