"""Product-review analytics on Spark: ingest, enrich, check, report and stream.

Every operator takes and returns DataFrames and is built from Spark's own column
expressions, so the plans stay inside the JVM and scale with the cluster.
"""

__version__ = "0.1.0"
