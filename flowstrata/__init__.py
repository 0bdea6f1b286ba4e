"""flowstrata: hierarchical flow-based communities of large directed
networks, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
