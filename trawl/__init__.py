"""trawl: a Spark-native engine for indexing and searching a corpus of web pages."""

__version__ = "0.1.0"
