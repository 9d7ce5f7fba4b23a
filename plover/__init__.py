"""plover: tabular profiling, cleaning and risk-model evaluation as Spark jobs.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` and ``pyspark.ml``; see README.md for the map.
"""

__version__ = "0.1.0"
