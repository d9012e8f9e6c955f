"""Market-data warehouse jobs written with the PySpark DataFrame API."""
