"""Point-in-time table analytics on PySpark DataFrames."""
