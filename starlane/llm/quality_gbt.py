"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text come from numpy passes over the UTF-8 bytes of a
batch. Training fits on a bounded sample of labelled documents (rows in order
of a hash of their id, at most ``sample_rows``); the trees are complete binary
trees flattened into arrays, and a batch walks all of them side by side.

Defined cases: a null text is the empty text and gets a score like any other;
labels without quality or id are not used, of several rows for one id the
lowest quality counts; without labels of both kinds every score is the share
of label 1 (0.5 without any); an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm import shingles as S
from starlane.llm.common import first_by_hash, text_or_empty

# The bound of the training sample, and the parameters of the fit.
SAMPLE_ROWS = 30_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.2
MIN_ROWS = 10
RIDGE = 1.0

# Classes of bytes whose shares are statistics.
_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "space": (0x20, 0x09, 0x0B, 0x0C, 0x0D),
    "newline": (10,),
    "stop": b".,;:?",
    "mark": b"!",
    "symbol": b"#*$%&|<>",
    "other": b"\"'()+-/=@[\\]^_`{}~",
    "high": range(128, 256),
}
_CLASS_OF = np.zeros(256, np.int64)
for _i, _members in enumerate(_CLASSES.values(), 1):
    _CLASS_OF[list(_members)] = _i

FEATURES = [
    *_CLASSES, "bytes", "words", "word_length", "word_spread", "short_words", "long_words", "distinct_words", "top_word", "twin_words",
    "distinct_runs", "lines", "line_length", "distinct_lines", "entropy",
]


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    data, off = S.utf8(texts)
    n = len(off) - 1
    size = np.diff(off)
    out = np.zeros((n, len(FEATURES)))
    if n == 0:
        return out
    col = {f: i for i, f in enumerate(FEATURES)}
    k = len(_CLASSES) + 1
    doc = np.repeat(np.arange(n), size)
    counts = np.bincount(doc * k + _CLASS_OF[data], minlength=n * k).reshape(n, k)
    per = np.maximum(size, 1)[:, None]
    out[:, : k - 1] = counts[:, 1:] / per
    share = counts / per
    out[:, col["entropy"]] = -(share * np.log(np.where(share > 0, share, 1))).sum(axis=1)
    out[:, col["bytes"]] = np.log1p(size)
    w = S.words(data, off, lower=True)
    number = w.count()
    some = np.maximum(number, 1)
    length = (w.ends - w.starts).astype(float)
    sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[w.offsets])
    out[:, col["words"]] = np.log1p(number)
    mean = sums(length) / some
    out[:, col["word_length"]] = mean
    out[:, col["word_spread"]] = np.sqrt(np.maximum(sums(length * length) / some - mean * mean, 0))
    out[:, col["short_words"]] = sums(length <= 3) / some
    out[:, col["long_words"]] = sums(length >= 12) / some
    twin = np.concatenate([[False], w.hashes[1:] == w.hashes[:-1]])
    out[:, col["twin_words"]] = sums(twin) / some
    runs = S.grams(w.hashes, 3)
    breaks = np.concatenate([data == 10, [False]])
    breaks_before = np.concatenate([[0], np.cumsum(breaks[:-1])])
    line_of = breaks_before[w.starts] if len(w.starts) else np.zeros(0, np.int64)
    for i in range(n):
        a, b = w.offsets[i], w.offsets[i + 1]
        if a == b:
            continue
        _, times = np.unique(w.hashes[a:b], return_counts=True)
        out[i, col["distinct_words"]] = len(times) / (b - a)
        out[i, col["top_word"]] = times.max() / (b - a)
        out[i, col["distinct_runs"]] = len(np.unique(runs[a : b - 2])) / (b - a - 2) if b - a > 2 else 1.0
        at = line_of[a:b]
        heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        line_hash = np.add.reduceat(S.mix64(w.hashes[a:b] + np.arange(b - a, dtype=np.uint64) - np.repeat(heads, np.diff(np.append(heads, b - a))).astype(np.uint64)), heads)
        out[i, col["lines"]] = np.log1p(len(heads))
        out[i, col["line_length"]] = np.log1p((b - a) / len(heads))
        out[i, col["distinct_lines"]] = len(np.unique(line_hash)) / len(heads)
    return out


@dataclass
class Trees:
    """Complete trees of one depth: node i has children 2i+1 and 2i+2."""

    base: float
    depth: int
    feature: np.ndarray  # trees x inner nodes
    above: np.ndarray  # go right if the statistic is above this
    value: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        if len(self.feature) == 0 or len(x) == 0:
            total = np.full(len(x), self.base)
        else:
            at = np.zeros((len(x), len(self.feature)), np.int64)
            tree = np.arange(len(self.feature))
            row = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                right = x[row, self.feature[tree, at]] > self.above[tree, at]
                at = 2 * at + 1 + right
            total = self.base + self.value[tree, at - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boosted trees on the logistic loss; splits by histograms of binned statistics."""
    inner = (1 << depth) - 1
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or len(y) == 0:
        share = share if len(y) else 0.5
        base = float(np.log(np.clip(share, 1e-9, 1) / np.clip(1 - share, 1e-9, 1)))
        return Trees(base, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    total = np.full(len(y), base)
    feature, above, value = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            best = np.full(width, 1e-9)
            cut = np.zeros(width, np.int64)
            for f in range(x.shape[1]):
                if not len(edges[f]):
                    continue
                key = local * bins + binned[:, f]
                hg, hh, hn = (
                    np.bincount(key, weights=v, minlength=width * bins).reshape(width, bins).cumsum(axis=1) for v in (g, h, np.ones(len(y)))
                )
                left = hg**2 / (hh + RIDGE)
                rest = (hg[:, -1:] - hg) ** 2 / (hh[:, -1:] - hh + RIDGE)
                gain = left + rest - hg[:, -1:] ** 2 / (hh[:, -1:] + RIDGE)
                gain[(hn < MIN_ROWS) | (hn[:, -1:] - hn < MIN_ROWS)] = -1
                gain[:, len(edges[f]) :] = -1
                at = gain.argmax(axis=1)
                most = gain[np.arange(width), at]
                for i in np.flatnonzero(most > best):
                    best[i], cut[i] = most[i], at[i]
                    feature[t, first + i], above[t, first + i] = f, edges[f][at[i]]
            fs = feature[t, node]
            node = 2 * node + 1 + (x[np.arange(len(y)), fs] > above[t, node])
        leaf = node - inner
        sums = np.bincount(leaf, weights=g, minlength=inner + 1)
        weight = np.bincount(leaf, weights=h, minlength=inner + 1)
        value[t] = rate * sums / (weight + RIDGE)
        total += value[t, leaf]
    return Trees(base, depth, feature, above, value)


def held_out(doc_id: Column) -> Column:
    """Rows the fit never sees: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _with_statistics(docs: DataFrame, extra: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.slices(batch):
                x = statistics(part.column("text"))
                rows = pa.array(list(x), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(extra), rows], [extra, "x"])

    return docs.mapInArrow(run, f"{extra} int, x array<double>")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on labelled documents outside the held-out third, at most ``sample_rows`` of them."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").cast("int").alias("_y"))
    known = first_by_hash(known.withColumn("_h", F.xxhash64("_id")), sample_rows, "_h").drop("_h")
    # At most sample_rows ids: a bounded broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text_or_empty().alias("text"))
    rows = rows.join(F.broadcast(known), "_id").select("_y", "text")
    found = _with_statistics(rows, "_y").toArrow()
    y = found.column("_y").to_numpy().astype(float)
    x = np.array(found.column("x").to_pylist()).reshape(len(y), len(FEATURES))
    # One order of rows whatever the partitions: sums come out alike.
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def _mark(columns: list[str]) -> str:
    """A beginning that no column's name has, for columns added beside them."""
    mark = "__"
    while any(c.lower().startswith(mark) for c in columns):
        mark += "_"
    return mark


def scored(docs: DataFrame, model: Trees, keep: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted per document; with ``keep`` those columns of ``docs`` and predicted."""

    mark = _mark([] if keep is None else keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.slices(batch, mark + "text"):
                score = model.scores(statistics(part.column(mark + "text")))
                columns = [part.column(c) for c in names]
                predicted = pa.array((score >= 0.5).astype(np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score), predicted], [*names, mark + "score", mark + "predicted"])

    if keep is None:
        rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_or_empty().alias(mark + "text"))
        names = ["doc_id", "held_out"]
    else:
        rows = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty().alias(mark + "text"))
        names = list(keep)
    fields = [f for f in rows.schema.fields if f.name != mark + "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{mark}score` double, `{mark}predicted` int"
    out = rows.mapInArrow(run, schema)
    if keep is None:
        return out.withColumnsRenamed({mark + "score": "score", mark + "predicted": "predicted"})
    return out


def accepted(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    model = train(spark, docs, labels, **options)
    rows = scored(docs, model, docs.columns)
    return rows.where(F.col(f"{_mark(docs.columns)}predicted") == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
