"""transitlake: a PySpark medallion lake for urban bus operations data.

GPS pings, trip-control records and the route catalogue are ingested as
raw text, typed into silver tables and joined into a daily performance
fact table.  Every step is a plain ``DataFrame -> DataFrame`` function
built from Spark's own operators.
"""

__version__ = "0.1.0"
