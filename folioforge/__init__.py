"""PySpark-native operators for preparing long-form and parallel text corpora."""
