"""Quality rules [native]: cross-document line frequency.

Lines are normalised (case and outer and inner white space) and hashed; per
host, the distinct documents that hold a line are counted. A line in more
documents than the limit is boilerplate and is removed, however large its
host; a document that loses too much of its words is rejected. Documents of
one text on a host are one document here, so a text is not boilerplate for
being copied.

Defined cases: a null text has no words and fails the base rules; a null
host is a host of its own; rows sharing a doc_id are judged each by its own
text; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.llm.common import WORD_PATTERN, text_or_empty, word_count

# A line is boilerplate on a host if more than MAX_DOCS distinct documents of it
# hold it. The one limit is the same on hosts of every size.
MAX_DOCS = 20
# A document is depleted when more than this share of its words goes.
MAX_LOST = 0.5

_SEPARATORS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def base_counts(docs: DataFrame, window: int = 3) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words per row.

    All in row-wise array expressions: no shuffle. Repeated windows are found
    by sorting (window hash, position): equal neighbours repeat.
    """
    text = F.col("_text")
    d = docs.withColumn("_text", text_or_empty())
    d = d.withColumn("_words", F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), F.lit(1)))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    d = d.withColumn("word_chars", _length_without(text, _SEPARATORS).cast("long"))
    d = d.withColumn("n_symbols", (F.length(text) - _length_without(text, _SYMBOLS)).cast("long"))
    with_word = F.filter(F.split(text, "\n"), lambda x: _length_without(x, _SEPARATORS) > 0)
    d = d.withColumn("_lines", with_word)
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    starts = F.when(F.col("n_words") >= window, F.sequence(F.lit(0), F.col("n_words").cast("int") - window))
    starts = F.coalesce(starts, F.array().cast("array<int>"))
    grams = F.transform(
        starts, lambda i: F.struct(F.xxhash64(*[F.get("_words", i + j) for j in range(window)]).alias("h"), i.alias("i"))
    )
    d = d.withColumn("_grams", F.sort_array(grams))
    twin = lambda x, k: F.get("_grams", k)["h"] == x["h"]
    kept = F.filter("_grams", lambda x, k: F.coalesce(twin(x, k - 1), F.lit(False)) | F.coalesce(twin(x, k + 1), F.lit(False)))
    d = d.withColumn("_at", F.sort_array(F.transform(kept, lambda x: x["i"])))
    covered = F.transform("_at", lambda p, k: F.least(F.lit(window), F.coalesce(F.get("_at", k + 1) - p, F.lit(window))))
    repeat = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", repeat).drop("_words", "_lines", "_grams", "_at", "_text")


def normal_line(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def frequent_lines(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """host, line hash, documents: lines above the limit on their host.

    Distinct (host, line, document) first, counts after: a very frequent line
    is spread over its documents before it meets in one counter.
    """
    text = text_or_empty()
    lines = docs.select(F.col(host).cast("string").alias("host"), F.xxhash64(text).alias("text_key"), F.explode(F.split(text, "\n")).alias("line"))
    lines = lines.where(_length_without(F.col("line"), _SEPARATORS) > 0)
    lines = lines.select("host", "text_key", F.xxhash64(normal_line(F.col("line"))).alias("line_hash"))
    return lines.groupBy("host", "line_hash").agg(F.countDistinct("text_key").alias("documents")).where(F.col("documents") > max_docs)


def lost_words(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """host, text_key, n_words_lost: words in removed lines, per distinct text that loses any."""
    text = text_or_empty()
    boiler = frequent_lines(docs, host, max_docs)
    lines = docs.select(F.col(host).cast("string").alias("_host"), F.xxhash64(text).alias("_text_key"), F.posexplode(F.split(text, "\n")))
    lines = lines.select("_host", "_text_key", "pos", F.xxhash64(normal_line(F.col("col"))).alias("_hash"), word_count(F.col("col")).alias("_n"))
    lines = lines.where("_n > 0")
    on = lines["_host"].eqNullSafe(boiler["host"]) & (lines["_hash"] == boiler["line_hash"])
    hit = lines.join(boiler, on).select(F.col("_host").alias("host"), F.col("_text_key").alias("text_key"), "pos", "_n")
    # Copies of a text on a host give the same (pos, _n) rows: count one set.
    return hit.distinct().groupBy("host", "text_key").agg(F.sum("_n").alias("n_words_lost"))


def without_frequent_lines(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text."""
    text = text_or_empty()
    boiler = frequent_lines(docs, host, max_docs)
    per_text = docs.select(F.col(host).cast("string").alias("_host"), F.xxhash64(text).alias("_text_key"), F.posexplode(F.split(text, "\n")))
    per_text = per_text.withColumn("_hash", F.xxhash64(normal_line(F.col("col"))))
    on = per_text["_host"].eqNullSafe(boiler["host"]) & (per_text["_hash"] == boiler["line_hash"])
    gone = per_text.join(boiler, on).groupBy(F.col("_host").alias("_h"), F.col("_text_key").alias("_k"))
    gone = gone.agg(F.map_from_entries(F.collect_set(F.struct("pos", F.lit(True).alias("v")))).alias("_gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("text", F.col("row")["text"]).withColumn("key", F.xxhash64(text))
    rows = rows.join(gone, F.col("row")[host].cast("string").eqNullSafe(F.col("_h")) & (F.col("key") == F.col("_k")), "left")
    left = F.filter(F.split("text", "\n"), lambda x, i: ~F.map_contains_key("_gone", i))
    new = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return rows.select(*[(new if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def quality_rules(docs: DataFrame, host: str = "source", max_docs: int = MAX_DOCS, max_lost: float = MAX_LOST) -> DataFrame:
    """doc_id, the base counts, base_failed, n_words_lost, kept per document."""
    lost = lost_words(docs, host, max_docs)
    d = docs.select("doc_id", F.col(host).cast("string").alias("_host"), F.col("text"), F.xxhash64(text_or_empty()).alias("_key"))
    d = base_counts(d).drop("text")
    on = d["_host"].eqNullSafe(lost["host"]) & (d["_key"] == lost["text_key"])
    d = d.join(lost, on, "left").withColumn("n_words_lost", F.coalesce("n_words_lost", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_words_lost") > max_lost * F.col("n_words")
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_words_lost",
    )
