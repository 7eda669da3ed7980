"""workloom: a PySpark-native job-market analytics engine."""

__version__ = "0.1.0"
