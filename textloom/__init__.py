"""textloom: a Spark-native engine for curating short-text corpora."""

__version__ = "0.1.0"
