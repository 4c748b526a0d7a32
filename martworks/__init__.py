"""martworks: batch analytics for marketplace data as PySpark DataFrame operators."""

__version__ = "0.1.0"
