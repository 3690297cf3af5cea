"""quarry: checked, analysed tables on Spark.

Operators are functions from DataFrames to DataFrames built on Spark's own
expressions; see README.md for the map of modules.
"""

__version__ = "0.1.0"
