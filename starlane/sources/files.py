"""File-level sources: month-file selection, landing, manifest, schema-drift
scan and sample slices (SC1, SC2, SC9-SC12)."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def month_start(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month")


def expected_files(span: DataFrame, start: Column, end: Column, feeds: Sequence[str]) -> DataFrame:
    """One row per (feed, month) from the month of ``start`` to that of ``end``
    inclusive, with the feed's monthly file name ``{feed}_tripdata_YYYY-MM.parquet``.

    ``span`` is usually a one-row aggregate; months come from ``sequence``
    over it (year rollover included), feeds from an exploded literal array.
    """
    months = span.select(
        F.explode(F.sequence(month_start(start), month_start(end), F.expr("interval 1 month"))).alias("m")
    )
    rows = months.select(F.explode(F.array(*[F.lit(f) for f in feeds])).alias("feed"), "m")
    return rows.select(
        "feed",
        F.year("m").alias("year"),
        F.month("m").alias("month"),
        F.concat(F.col("feed"), F.lit("_tripdata_"), F.date_format("m", "yyyy-MM"), F.lit(".parquet")).alias(
            "file_name"
        ),
    )


def expected_files_between(spark: SparkSession, start: str, end: str, feeds: Sequence[str]) -> DataFrame:
    """``expected_files`` for literal "YYYY-MM" bounds; bad text raises ValueError."""
    import re

    for text in (start, end):
        if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", text):
            raise ValueError(f"month must be YYYY-MM, got {text!r}")
    one = spark.range(1).select(F.lit(start + "-01").alias("s"), F.lit(end + "-01").alias("e"))
    return expected_files(one, F.col("s"), F.col("e"), feeds)


def land_feed(raw: DataFrame, root: str, ts_col: str = "pickup_datetime", feed_col: str = "taxi_type") -> str:
    """Write raw trips to a landing zone partitioned by feed and month
    (``feed=yellow/month=2024-10/part-*.parquet``), the Spark-side form of
    monthly files; reading a month range is then partition pruning.

    Rows are rebalanced on feed and month first, so a month is written by a
    few tasks; AQE splits a large one.
    """
    (
        raw.withColumn("feed", F.col(feed_col))
        .withColumn("month", F.date_format(ts_col, "yyyy-MM"))
        .drop(feed_col)
        .hint("rebalance", "feed", "month")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("feed", "month")
        .parquet(root)
    )
    return root


def land_monthly_files(raw: DataFrame, root: str, ts_col: str = "pickup_datetime", feed_col: str = "taxi_type") -> str:
    """Write raw trips under the monthly names ``{feed}_tripdata_YYYY-MM.parquet``,
    below one folder per feed. Trips without a time are of no month and stay out."""
    name = F.concat(F.col(feed_col), F.lit("_tripdata_"), F.date_format(ts_col, "yyyy-MM"), F.lit(".parquet"))
    (
        raw.where(F.col(ts_col).isNotNull())
        .withColumn("feed", F.col(feed_col))
        .withColumn("file", name)
        .drop(feed_col)
        .hint("rebalance", "feed", "file")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("feed", "file")
        .parquet(root)
    )
    return root


def read_months(spark: SparkSession, root: str, feed: str, first: str, last: str) -> DataFrame:
    """Trips of one feed for months first..last ("YYYY-MM"), pruned by partition."""
    df = spark.read.parquet(root)
    m = F.col("month").cast("string")
    return df.where((F.col("feed") == feed) & (m >= first) & (m <= last)).drop("feed", "month")


def monthly_files(spark: SparkSession, root: str, feed: str, first: str, last: str) -> list[str]:
    """Paths of a feed's files for months first..last, by their names (one
    entry per file of the landing; contents are not read)."""
    found = file_listing(spark, root).select("path", *_named(F.col("path")))
    ym = F.format_string("%04d-%02d", F.col("year"), F.col("month"))
    found = found.where((F.col("feed") == feed) & (ym >= first) & (ym <= last))
    return sorted(r["path"] for r in found.select("path").collect())


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of every Parquet file under ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length")
    )


def _named(path: Column) -> list[Column]:
    """feed, year, month of a landed file: from ``feed=../month=..`` folders or
    from the name ``{feed}_tripdata_YYYY-MM.parquet`` of the file or its folder."""
    pattern = r"(?:feed=([^/]+)/month=(\d{4})-(\d{2})|([^/=]+)_tripdata_(\d{4})-(\d{2})\.parquet)"
    part = lambda folder, name: F.concat(F.regexp_extract(path, pattern, folder), F.regexp_extract(path, pattern, name))
    return [part(1, 4).alias("feed"), part(2, 5).try_cast("int").alias("year"), part(3, 6).try_cast("int").alias("month")]


def file_manifest(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """Expected (feed, month) files joined to what landed: presence, file
    count and bytes per expected file."""
    landed = (
        file_listing(spark, root)
        .select(*_named(F.col("path")), "length")
        .groupBy("feed", "year", "month")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
    )
    return expected.join(landed, ["feed", "year", "month"], "left").select(
        "feed",
        "year",
        "month",
        "file_name",
        F.col("n_files").isNotNull().alias("file_present"),
        F.coalesce("n_files", F.lit(0)).alias("n_files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """One row: files present, files missing, total MB (2 dp), month range, feeds."""
    ym = F.format_string("%04d-%02d", F.col("year"), F.col("month"))
    return manifest.agg(
        F.count(F.when(F.col("file_present"), F.lit(1))).alias("files_present"),
        F.count(F.when(~F.col("file_present"), F.lit(1))).alias("files_missing"),
        F.round(F.sum("bytes") / F.lit(1024.0 * 1024.0), 2).alias("total_size_mb"),
        F.concat(F.min(ym), F.lit(" to "), F.max(ym)).alias("date_range"),
        F.array_join(F.array_sort(F.collect_set("feed")), ", ").alias("taxi_types"),
    )


def _shape(schema: T.StructType) -> str:
    return ",".join(sorted(f"{f.name.lower()}:{f.dataType.simpleString()}" for f in schema.fields))


# Footers that are read at the same time.
FOOTER_READERS = 16


def _schemas(spark: SparkSession, paths: Sequence[str]) -> list[T.StructType]:
    """The schema of each path, from one footer, by Spark's own reader: any
    store that Spark opens, several at a time."""
    with ThreadPoolExecutor(FOOTER_READERS) as pool:
        return list(pool.map(lambda p: spark.read.parquet(p).schema, paths))


def _reader_widens(have: T.DataType, want: T.DataType) -> bool:
    """Whether Spark's Parquet reader itself gives ``have`` as ``want``, without loss."""
    if have == want:
        return True
    x, y = have.simpleString(), want.simpleString()
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return want.scale >= have.scale and want.precision - want.scale >= have.precision - have.scale
    whole = ("tinyint", "smallint", "int")
    return (x in whole and y in ("int", "bigint", "double")) or (x, y) in (("float", "double"), ("date", "timestamp_ntz"))


def _lossless(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast; a bigint that no double equals is an error, not another number."""
    if not (isinstance(have, T.LongType) and isinstance(want, T.DoubleType)):
        return c.cast(want)
    near = c.cast("double")
    same = c.isNull() | (c.cast("decimal(20,0)") == near.cast("decimal(20,0)"))
    lost = F.raise_error(F.concat(F.lit("no double holds "), c.cast("string"))).cast("double")
    return F.when(same, near).otherwise(lost)


def scan_feed(spark: SparkSession, paths: Sequence[str], target: T.StructType | None = None) -> DataFrame:
    """Read feed files whose column types drift between files.

    One multi-file read fails when a column is double in one month and
    bigint in another, and so does ``mergeSchema``. So each file's schema is
    read first (footers only) and ``target`` found (default: for each column
    the narrowest type that holds every file's values). All files whose types
    the Parquet reader itself widens to it are one scan under that declared
    schema; files of other types are one scan for each distinct schema, cast.
    Columns are matched by name, case-insensitively; a column that a file
    lacks is null there. Beside doubles a bigint becomes a double; one that no
    double equals (some above 2^53) ends the read with an error.
    """
    if not paths:
        raise ValueError("no files to scan")
    found = list(zip(paths, _schemas(spark, paths)))
    if target is None:
        target = _holding_all([schema for _, schema in found])
    wanted = {f.name.lower(): f for f in target.fields}
    widened: list[str] = []
    groups: dict[str, list[tuple[str, T.StructType]]] = {}
    for path, schema in found:
        if all(_reader_widens(f.dataType, wanted[f.name.lower()].dataType) for f in schema.fields if f.name.lower() in wanted):
            widened.append(path)
        else:
            groups.setdefault(_shape(schema), []).append((path, schema))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in target.fields])
    parts = [spark.read.schema(nullable).parquet(*widened)] if widened else []
    for some in groups.values():
        have = {f.name.lower(): f for f in some[0][1].fields}
        df = spark.read.schema(some[0][1]).parquet(*[p for p, _ in some])
        cols = [
            (_lossless(F.col(f"`{have[n].name}`"), have[n].dataType, f.dataType) if n in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for n, f in wanted.items()
        ]
        parts.append(df.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Digits before the point that the integer types need as decimals.
_WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds all values of both without loss."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    x, y = a.simpleString(), b.simpleString()
    whole, real = list(_WHOLE_DIGITS), ("float", "double")
    if x in whole and y in whole:
        return a if whole.index(x) > whole.index(y) else b
    if (x in whole or x in real) and (y in whole or y in real):
        return T.DoubleType()  # a float holds no large integers
    digits = [
        (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE_DIGITS[n], 0) if n in _WHOLE_DIGITS else None
        for t, n in ((a, x), (b, y))
    ]
    if all(digits):
        left, scale = max(d[0] for d in digits), max(d[1] for d in digits)
        return T.DecimalType(left + scale, scale) if left + scale <= 38 else T.StringType()
    if {x, y} <= {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    return T.StringType()


def _holding_all(schemas: Sequence[T.StructType]) -> T.StructType:
    fields: dict[str, T.StructField] = {}
    for s in schemas:
        for f in s.fields:
            k = f.name.lower()
            kind = _common_type(fields[k].dataType, f.dataType) if k in fields else f.dataType
            fields[k] = T.StructField(fields[k].name if k in fields else f.name, kind, True)
    return T.StructType(list(fields.values()))


def sample_slice(df: DataFrame, n: int, order_by: Sequence[str | Column], path: str) -> int:
    """Write the first ``n`` rows under a total order to ``path``; return rows written.

    Planned as TakeOrderedAndProject: each task keeps its best ``n`` rows,
    so the full input is never sorted or collected.
    """
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    df.orderBy(*order).limit(n).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()
