"""loomkit: Spark-native data steps for machine-learning work.

Every operator is a function from DataFrames to a DataFrame, built on
Spark SQL built-ins so Catalyst can prune, push down and plan it.
"""

__version__ = "0.1.0"
