"""Close-approach analytics expressed as Spark DataFrame, MLlib and streaming jobs."""

__version__ = "0.1.0"
