"""News-trend analytics as plain PySpark DataFrame operators."""
