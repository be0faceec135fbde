"""lodestar — fuzzy-cluster semantic retrieval over text corpora, on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the
public PySpark DataFrame / SQL / ML / Structured Streaming APIs.
"""

__version__ = "0.1.0"
