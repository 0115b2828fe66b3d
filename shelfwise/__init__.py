"""Product-record matching and master-data analytics as PySpark DataFrame plans."""
