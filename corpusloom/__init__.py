"""A PySpark-native engine for turning crawled pages into tokenizer-ready corpora."""

__version__ = "0.1.0"
