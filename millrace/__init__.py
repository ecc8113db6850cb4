"""Millrace: a Spark-native engine for curating, profiling and scoring training corpora."""

__version__ = "0.1.0"
