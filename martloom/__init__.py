"""Commerce marts and customer segmentation as plain Spark DataFrame jobs."""

__version__ = "0.1.0"
