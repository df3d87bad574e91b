"""ringwatch: point-in-time transfer-graph analytics on Spark DataFrames.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
column expression) and leaves execution to Catalyst; nothing is collected to
the driver except scalars that must become literals (boundaries, k cutoffs,
scaler moments).
"""

__version__ = "0.1.0"
