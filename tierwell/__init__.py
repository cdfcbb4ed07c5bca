"""tierwell: layered (bronze / silver / gold) data work on PySpark.

Every operator is a function from DataFrames to a DataFrame built on Spark's own
expressions, joins, aggregates and windows.  Nothing here starts a session.
"""

__version__ = "0.1.0"
