"""roadbook: crash-record curation and analytics as lazy Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (reports
are small DataFrames too); nothing runs until an action or a sink is called.
"""

from roadbook.session import checkpoint_dir, get_spark, materialize

__all__ = ["get_spark", "checkpoint_dir", "materialize"]
