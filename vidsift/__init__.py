"""vidsift: a PySpark-native analytics engine for short-form video research data."""
