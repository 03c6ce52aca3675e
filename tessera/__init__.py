"""tessera: Spark-native data operators for the ML lifecycle.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` expressions, so Catalyst sees the whole plan.
"""

__version__ = "0.1.0"
