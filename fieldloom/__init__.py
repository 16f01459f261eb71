"""Survey-to-trend analytics as PySpark DataFrame operators."""
