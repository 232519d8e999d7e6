"""quarry: Spark-native batch and streaming data jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or a fit/apply
pair whose fitted parameters are small values or small DataFrames).  No
module creates a SparkSession; callers own the session.
"""

__version__ = "0.1.0"
