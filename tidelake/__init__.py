"""Point-in-time market analytics as PySpark DataFrame operators."""
