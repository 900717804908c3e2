"""txpipe: card-transaction fraud analytics as Spark DataFrame jobs.

Everything is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, windows, joins and aggregates; MLlib for the classifiers and
Structured Streaming for scoring and hourly counts. No Python UDFs.
"""

__version__ = "0.1.0"
