"""strataward: build, check and repair a lake of keyed, dated tables with Spark.

Every operator takes and returns DataFrames. See README.md for the map from
capability to function.
"""

__version__ = "0.1.0"
