"""Trip analytics as lazily evaluated PySpark DataFrame jobs."""

__version__ = "0.1.0"
