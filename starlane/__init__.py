"""starlane: star-schema trip analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and is
built from built-in Spark expressions only, so Catalyst can prune, push
down and code-generate the whole chain from raw files to serving queries.
"""

__version__ = "0.1.0"
