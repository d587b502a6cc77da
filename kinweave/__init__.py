"""kinweave: a Spark-native engine for record linkage, reconciliation and data repair."""

__version__ = "0.1.0"
