"""Customer-retention analytics as DataFrame functions on Apache Spark."""

__version__ = "0.1.0"
