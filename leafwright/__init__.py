"""leafwright: document-structure processing over page blocks and trees, on Spark DataFrames."""

__version__ = "0.1.0"
