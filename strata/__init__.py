"""strata: layered (bronze / silver / gold) analytics operators on Spark.

Every operator is a function from DataFrames to a DataFrame. Nothing here
calls an action except the sinks, the reports and the measurement harness.
"""

__version__ = "0.1.0"
