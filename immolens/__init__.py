"""immolens: listing snapshots, history and market tables on Spark."""

__version__ = "0.1.0"
