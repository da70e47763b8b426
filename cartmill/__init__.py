"""Daily retail lakehouse on PySpark: JSON feeds to a star schema to reports."""
