"""Written intermediate tables and the column conventions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.session import scratch_path, settings, ship_package

# A word is a maximal run of characters other than space and \t \n \v \f \r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Settings for the jobs that write an intermediate table: shuffle files go as
# soon as the table is written (it is the recovery point, not the shuffle),
# and Python tasks see batches of bounded height, as rows may be long texts.
_WRITE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.parquet.compression.codec": "zstd",
    # Joins with a small list of ids filter the large side before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Later steps then start from files every executor can reach, so a lost
    executor costs only its running tasks.
    """
    path = scratch_path(spark, f"llm-{name}")
    with settings(spark, _WRITE_CONF):
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for files in (table.inputFiles() for table in tables):
        for folder in {f.rsplit("/", 1)[0] for f in files if "/starlane/llm-" in f}:
            at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def with_package(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query(spark, ...)`` with this package on the executors."""

    @wraps(query)
    def run(spark: SparkSession, *args, **options) -> DataFrame:
        ship_package(spark)
        return query(spark, *args, **options)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def some_ids(ids: DataFrame, column: str) -> DataFrame:
    """``ids`` marked as a selection: Spark builds a runtime Bloom filter for a
    join only from a side that has a filter."""
    return ids.where(F.col(column) >= F.lit(-(2**63)))


def first_by_hash(rows: DataFrame, number: int, hashed: str) -> DataFrame:
    """At most ``number`` of the distinct ``rows``: the least by the 64-bit hash in
    that column, as unsigned, then by all columns.

    One count of the hashes' leading zero bits tells how many bits leave enough
    rows, so about twice ``number`` rows meet at most, however many there are.
    """
    zeros = (F.lit(64) - F.length(F.bin(F.col(hashed)))).alias("zeros")
    counts = dict(rows.select(hashed).distinct().groupBy(zeros).count().collect())  # at most 65 rows
    least, held = max(counts, default=0), 0
    for least in sorted(counts, reverse=True):
        held += counts[least]
        if held >= number:
            break
    some = rows.where(zeros >= least).distinct()
    return some.orderBy(zeros.desc(), hashed, *rows.columns).limit(number)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(WORD_PATTERN)).cast("long")


def null_safe_on(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond
