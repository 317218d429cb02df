"""postsieve: keyword monitoring of short social posts on Spark.

Every operator is a function from DataFrames to a DataFrame.  Start with
``postsieve.plans`` for whole jobs and ``postsieve.operators`` for the pieces.
"""

__version__ = "0.1.0"
