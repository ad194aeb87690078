"""shopmetrics: a product-catalogue lakehouse (bronze -> silver -> gold -> features -> model) on Spark.

Every operator is a function from DataFrame(s) to DataFrame; the caller owns the SparkSession.
"""

__version__ = "0.1.0"
