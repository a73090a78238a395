"""Research-lab analytics as PySpark DataFrame jobs."""
