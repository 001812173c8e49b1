"""Weather-forecast reliability and logistics risk, as PySpark DataFrame jobs."""
