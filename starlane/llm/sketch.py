"""Document fingerprints: threshold-scaled sketch.

A fingerprint keeps every shingle hash below 2^64 / scale. Two sketches of
one scale merge by union, and as the kept hashes are a fixed random part of
all shingles, shares of them estimate containment and likeness however
unequal the documents are. A finer sketch reduces to a coarser one by its
threshold, so documents too small for the base scale keep a finer one (by
steps of 4, down to all shingles) and pairs are compared on the coarser.

Defined cases: a null text is the empty text; the empty text has the empty
fingerprint, alike (1.0) to another empty one and unlike (0.0) anything else;
ties of doc_id are ordered by text; one document is its own next one; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm import shingles as S
from starlane.llm.common import text_or_empty

SCALE = 16
MIN_HASHES = 32
SHINGLE_WORDS = 5

_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _below(scale: int) -> np.uint64:
    return np.uint64((1 << 64) // scale - 1)


def sketches(texts: list[str], scale: int = SCALE, min_hashes: int = MIN_HASHES, k: int = SHINGLE_WORDS) -> list[tuple[int, np.ndarray]]:
    """(scale used, ascending hashes below its threshold) of each text."""
    out: list[tuple[int, np.ndarray]] = []
    column = pa.array(texts, pa.large_string())
    for part in S.slices(pa.RecordBatch.from_arrays([column], ["text"])):
        hashes, off = S.shingle_sets(S.words(*S.utf8(part.column("text"))), k)
        for i in range(part.num_rows):
            own = hashes[off[i] : off[i + 1]]
            at = scale
            n = np.searchsorted(own, _below(at), "right")
            while n < min_hashes and at > 1:
                at = max(1, at // 4)
                n = np.searchsorted(own, _below(at), "right")
            out.append((at, own[:n].copy()))
    return out


def to_text(sketch: tuple[int, np.ndarray]) -> str:
    return f"{sketch[0]}:" + sketch[1].astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> tuple[int, np.ndarray]:
    scale, _, body = fingerprint.partition(":")
    return int(scale), np.frombuffer(bytes.fromhex(body), ">u8").astype(np.uint64)


def common(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, int, int]:
    """Hashes of a, of b and of both, at the coarser scale of the two."""
    limit = _below(max(a[0], b[0]))
    x, y = (s[1][: np.searchsorted(s[1], limit, "right")] for s in (a, b))
    return len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated Jaccard similarity."""
    x, y, both = common(a, b)
    if x + y == 0:
        return 1.0 if len(a[1]) == len(b[1]) == 0 else 0.0
    return both / (x + y - both)


def containment(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Estimated share of a's shingles that b has."""
    x, _, both = common(a, b)
    return both / x if x else 0.0


def merged(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
    """Sketch of the two shingle sets' union."""
    scale = max(a[0], b[0])
    x = np.union1d(a[1], b[1])
    return scale, x[: np.searchsorted(x, _below(scale), "right")]


def fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """doc_id, n_chars, fingerprint of each document (map-only)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.slices(batch):
                texts = part.column("text").to_pylist()
                prints = [to_text(s) for s in sketches(texts, scale)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())],
                    ["doc_id", "n_chars", "fingerprint"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (part, ahead, doc_id, text); each real row meets the next row of its part."""
    held: tuple | None = None  # (part, ahead, doc_id, text) of the row whose next is due
    for batch in batches:
        for piece in S.slices(batch):
            rows = list(zip(*[piece.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "text")], strict=True))
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1] and a[0] == b[0]]
            if not pairs:
                continue
            texts = [a[3] for a, _ in pairs]
            follow = [b[3] for _, b in pairs]
            cut = [len(t) // 4 for t in texts]
            edits = [t[: len(t) - n] + f[:n] for t, f, n in zip(texts, follow, cut, strict=True)]
            own = sketches(texts)
            # A pair's next text is mostly the next pair's text.
            after = [own[i + 1] if i + 1 < len(texts) and follow[i] is texts[i + 1] else None for i in range(len(texts))]
            late = [i for i, s in enumerate(after) if s is None]
            for i, s in zip(late, sketches([follow[i] for i in late]), strict=True):
                after[i] = s
            new = sketches(edits)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[2] for a, _ in pairs], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edits], pa.string()),
                    pa.array([to_text(s) for s in own], pa.string()),
                    pa.array([to_text(s) for s in new], pa.string()),
                    pa.array([likeness(a, b) for a, b in zip(own, new, strict=True)], pa.float64()),
                    pa.array([likeness(a, b) for a, b in zip(own, after, strict=True)], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )


def _rank(value: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (ascending) at or below ``value``: a binary search; null ranks 0."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(table, at + s - 1) <= value, at + s).otherwise(at))


def against_next(spark: SparkSession, docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its text with the last quarter
    replaced by the beginning of the next document in ascending doc_id.

    The id range is cut into parts, a few per shuffle partition; one pass
    over the ids finds each part's first id. That document also goes, marked
    ``ahead``, to the end of the part before (the very first one to the last
    part), so each part holds all its pairs. The texts shuffle once.
    """
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    known = ids.where(F.col("doc_id").isNotNull())
    cuts = known.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    bounds = sorted({int(c) for c in cuts})
    seen = ids.groupBy(_rank(F.col("doc_id"), bounds).alias("part")).agg(
        F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("nulls")
    )
    firsts = {r["part"]: None if r["nulls"] else r["low"] for r in seen.collect()}  # a row per part
    full = sorted(firsts)
    if not full:
        return spark.createDataFrame([], _SCHEMA)
    before = {p: full[i - 1] for i, p in enumerate(full)}  # of the first part: the last
    low = F.array(*[F.lit(firsts.get(p)).cast("long") for p in range(full[-1] + 1)])
    previous = F.array(*[F.lit(before.get(p)).cast("int") for p in range(full[-1] + 1)])
    rows = rows.withColumn("part", _rank(F.col("doc_id"), bounds).cast("int"))
    ahead = F.when(F.col("doc_id").eqNullSafe(F.get(low, F.col("part"))), F.get(previous, F.col("part")))
    to = F.array(F.struct(F.col("part").alias("p"), F.lit(False).alias("ahead")), F.struct(ahead.alias("p"), F.lit(True).alias("ahead")))
    rows = rows.withColumn("to", F.explode(F.filter(to, lambda x: x["p"].isNotNull())))
    rows = rows.select(F.col("to.p").alias("part"), F.col("to.ahead").alias("ahead"), "doc_id", "text")
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "ahead", F.col("doc_id").asc_nulls_first(), "text")
    return rows.mapInArrow(_edited, _SCHEMA)
