"""tessera: corpus curation and analytics operators on PySpark."""

__version__ = "0.1.0"
