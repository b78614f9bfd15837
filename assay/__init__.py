"""Data quality, typed layers and training-data operators on PySpark."""
