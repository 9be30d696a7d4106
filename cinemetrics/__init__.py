"""Ratings analytics on PySpark DataFrames.

Per-genre and per-user statistics, exact top-k per group, rating-matrix column
statistics, item-item adjusted cosine with nearest-neighbour prediction, and
ALS recommendation with a timestamp split and grid search. Every operator is a
function from DataFrames to a DataFrame built from Spark SQL expressions,
joins, windows and ``pyspark.ml``.
"""

__version__ = "0.1.0"
