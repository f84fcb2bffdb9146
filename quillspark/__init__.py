"""quillspark: a PySpark-native engine for structured document corpora."""
