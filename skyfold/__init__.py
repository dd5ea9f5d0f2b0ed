"""Sky-survey catalog building and validation on Spark DataFrames."""

__version__ = "0.1.0"
