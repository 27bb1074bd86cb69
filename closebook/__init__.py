"""Month-end custody reporting as PySpark DataFrame code."""
