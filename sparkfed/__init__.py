"""Spark-native querying of externally stored tables through declared schemas."""

__version__ = "0.1.0"
