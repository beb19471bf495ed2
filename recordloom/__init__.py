"""PySpark-native reconciliation analytics: extraction, normalisation, matching, merging and ordered folds."""

__version__ = "0.1.0"
