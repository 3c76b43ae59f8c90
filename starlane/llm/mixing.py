"""Mixing sources to target weights [native].

Every document gets a hash-random key. Each source is cut into ranges of
that key, range totals are prefix-summed, and inside a range a window sums
on: together an exact prefix sum of token counts over the source, without a
task that holds a whole source. The mix takes the prefix up to the source's
exact budget; a budget above the source's size repeats whole epochs first.

Defined cases: a null text has size 0 and is never taken; a null source is a
source of its own, last in order; a null doc_id and repeated rows are
documents like any other; an empty table gives no rows; further columns of
any name are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.llm.common import materialize, null_safe_on, text_or_empty, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
# Documents in one range of a source's random order, on average: one window
# group. The number of ranges follows the row count.
ROWS_PER_RANGE = 20_000


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target size of each source from its total size.

    ``totals`` has one row per source: source, source_size. Sources by code
    point (null last) weigh ``weights``, repeating, and share the grand
    total; none gets more than ``max_epochs`` times its size, and the excess
    goes to the others by weight. That settles at a water level: a source is
    capped exactly when cap/weight is at most the level the rest ends on.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("_w", w).withColumn("_cap", F.col("source_size").cast("double") * max_epochs)
    t = t.withColumn("_level", F.col("_cap") / F.col("_w"))
    # Ascending levels: if all sources before this one are capped, the rest
    # shares what is left; the first whose level is not below that ends it.
    by_level = Window.orderBy("_level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    left = F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    t = t.withColumn("_share", left / F.sum("_w").over(after))
    t = t.withColumn("_water", F.min(F.when(F.col("_level") >= F.col("_share"), F.struct("_level", "_share"))).over(every)["_share"])
    target = F.round(F.least(F.col("_cap"), F.col("_water") * F.col("_w")), 6)
    return t.select("source", "source_size", target.alias("target"))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, text_key per document.

    ``taken`` is the number of words the mix takes of the document, repeats
    counted. Only the one document on which a source's budget ends is taken
    in part. ``text_key`` tells apart rows that share a doc_id.
    """
    text = text_or_empty()
    sized = docs.select(
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(text).alias("text_key"),
    )
    sized = materialize(spark, sized, "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    targets = source_targets(totals.select("source", "source_size"), weights, max_epochs)
    # One row per source: the only part that meets in one task.
    plan = targets.join(totals.select(F.col("source").alias("_s"), "_n"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = materialize(spark, plan.withColumn("_ranges", F.ceil(F.col("_n") / F.lit(rows_per_range)).cast("long")), "mix-targets")

    name = F.concat_ws("-", F.lit("mix"), F.col("doc_id").cast("string"), "source")
    keyed = sized.withColumn("__key", F.md5(name))
    keyed = keyed.join(plan.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # Range of the key: its upper 32 bits, scaled.
    upper = F.conv(F.substring("__key", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("_range", F.shiftright(upper * F.col("_ranges"), 32))

    spans = keyed.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    up_to = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("source").alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(up_to), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("source", "_range").orderBy("__key", "doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(spans, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_base") - F.col("_in")))
    return rows.select(
        "doc_id", "size", "source", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken"), "text_key"
    )


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``: a document comes once per epoch it is in.

    The document on which a budget ends is kept whole if at least half of it
    is within, so a source ends at most half a document off its budget.
    Documents without words take nothing and do not appear.
    """
    plan = mix(spark, docs, **options)
    times = F.floor(F.col("taken") / F.col("size")) + F.when(2 * (F.col("taken") % F.col("size")) >= F.col("size"), 1).otherwise(0)
    plan = plan.where(F.col("size") > 0).select(
        F.col("doc_id").alias("_d"), F.col("source").alias("_src"), F.col("text_key").alias("_k"), times.cast("int").alias("_times")
    )
    # Repeated rows have equal keys; each key once, so the join adds none.
    plan = plan.where("_times > 0").groupBy("_d", "_src", "_k").agg(F.sort_array(F.collect_list("_times"), asc=False).alias("_times"))
    plan = materialize(spark, plan, "mix-plan")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    doc_id, source = F.col("row")["doc_id"], F.col("row")["source"]
    rows = rows.withColumn("key", F.xxhash64(F.coalesce(F.col("row")["text"].cast("string"), F.lit("")))).withColumn("nth", F.lit(1))
    if plan.where(F.size("_times") > 1).limit(1).count():
        # Rows of one key that differ elsewhere are told apart by all their columns.
        same = Window.partitionBy(doc_id, source, "key").orderBy(F.to_json("row"))
        rows = rows.withColumn("nth", F.row_number().over(same))
    on = doc_id.eqNullSafe(F.col("_d")) & source.eqNullSafe(F.col("_src")) & (F.col("key") == F.col("_k"))
    rows = rows.join(plan, on).where(F.col("nth") <= F.size("_times"))
    copies = F.sequence(F.lit(1), F.element_at("_times", F.col("nth")))
    return rows.select("row", F.explode(copies)).select(*[F.col("row")[c].alias(c) for c in docs.columns])
