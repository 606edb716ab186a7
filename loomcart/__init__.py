"""E-commerce event processing and order analytics as plain PySpark jobs."""

__version__ = "0.1.0"
