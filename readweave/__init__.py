"""readweave: reference-free variant discovery and text processing on Spark DataFrames."""

__version__ = "0.1.0"
