"""A Spark-first engine for building, cleaning, searching and auditing lexicons."""

__version__ = "0.1.0"
