"""tripflow: bike-share trip and station analytics on Spark.

Every operation is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, joins, aggregates and Structured Streaming, so the same code runs
on ``local[*]`` and on a large cluster. Only ``sources``, ``sinks`` and the job
entry points in ``plans`` touch storage.
"""

__all__ = ["session", "schemas"]
