"""Statistics, data quality, privacy and utility of synthetic tables, as lazy Spark plans."""

__version__ = "0.1.0"
