"""Feature engineering, freshness and snapshots for Spark tables and streams."""

__version__ = "0.1.0"
