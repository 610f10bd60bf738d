"""Small-area risk analytics on Spark: events to blocks, block-year panels, risk models."""

__version__ = "0.1.0"
