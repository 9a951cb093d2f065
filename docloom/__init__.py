"""docloom: a Spark-first engine for document-processing tables."""

__version__ = "0.1.0"
