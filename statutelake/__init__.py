"""statutelake: statute-corpus analytics as PySpark DataFrame jobs."""
