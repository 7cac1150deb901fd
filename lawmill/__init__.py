"""lawmill: a document-acquisition and corpus-processing engine on Spark DataFrames."""

__version__ = "0.1.0"
