"""The warehouse operators, each a DataFrame -> DataFrame function built from Spark expressions."""
