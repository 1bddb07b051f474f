"""Dataset curation on Spark: every operation is DataFrame -> DataFrame or Column -> Column."""

__version__ = "0.1.0"
