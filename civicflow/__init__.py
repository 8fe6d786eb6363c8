"""civicflow: service-ticket analytics as lazy Spark DataFrame transforms."""

__version__ = "0.1.0"
