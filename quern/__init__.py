"""quern: a Spark-native engine for scanning, scoring and analysing document annotations."""

__version__ = "0.1.0"
