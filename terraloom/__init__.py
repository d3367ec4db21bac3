"""terraloom: feature-table analytics as lazy Spark DataFrame programs."""

__version__ = "0.1.0"
