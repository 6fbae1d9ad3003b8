"""millrace: configured reads, message ingest, conversions and control reports on Spark.

Every operator is a function from DataFrame to DataFrame (or from Column to Column) and is
meant to be chained with ``df.transform``. Nothing here runs rows through the driver.
"""

__version__ = "0.1.0"
