"""arena: competition, basket and catalogue analytics as PySpark DataFrame jobs."""
