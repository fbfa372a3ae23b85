"""Customer-activity analytics as DataFrame-to-DataFrame operators on PySpark."""
