"""corpusflow: captured pages, listings and post feeds to a clean article corpus on Spark."""

__version__ = "0.1.0"
