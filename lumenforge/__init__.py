"""A Spark-native engine for star catalogues and training-data preparation."""
