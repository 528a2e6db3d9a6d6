"""knotwork: property-graph and entity-resolution analytics on Spark DataFrames."""

__version__ = "0.1.0"
