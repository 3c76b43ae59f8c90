"""Substring dedup: suffix automata of reference shards, matching statistics of documents.

A word goes if a window of WINDOW words over it also starts in a document
with a smaller doc_id; windows are judged on the input.

Reference: of every passage that several documents share, the text around it
in the smallest document. To find it, each window picks the smallest hash of
its word runs as its anchor (equal windows pick equal anchors); an anchor in
several documents is live and belongs to the smallest of them, its owner. The
live text of an owner is one reference shard, made into a suffix automaton;
it goes out to the tasks that hold the live text of other documents with its
anchors. They stream that text through the automaton, and where the matching
statistic reaches WINDOW, the window lies in the owner. An owner with much
text against it is sent to several tasks.

A window can have its anchor but not itself in the owner: such windows can
only repeat among themselves. They go through the same steps once more, with
the hash of the whole window as the anchor, after which none is left.

Equal texts are settled before: all windows of a later copy start in the
first one.

Defined cases: null and empty texts have no words; texts under WINDOW words
lose none; rows with a null doc_id are neither earlier nor later than others
and lose none; rows sharing a doc_id lose nothing to each other; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm import shingles as S
from starlane.llm.common import WORD_PATTERN, materialize, text_or_empty

WINDOW = 50
ANCHOR_WORDS = 16
# Words streamed against one copy of an automaton, about.
SLICE_WORDS = 200_000

_U = np.uint64


class Automaton:
    """Suffix automaton of word sequences; their ends are unique separators."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.last, self.ends = 0, 0

    def add(self, words: list[int]) -> None:
        nxt, link, size, last = self.next, self.link, self.size, self.last
        self.ends += 1
        for c in [*words, -self.ends]:  # word hashes are not negative
            new = len(nxt)
            nxt.append({})
            size.append(size[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if size[p] + 1 == size[q]:
                    link[new] = q
                else:
                    twin = len(nxt)
                    nxt.append(dict(nxt[q]))
                    size.append(size[p] + 1)
                    link.append(link[q])
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.last = last

    def statistics(self, words: list[int]) -> np.ndarray:
        """For each word, the longest run that ends there and is in the reference."""
        nxt, link, size = self.next, self.link, self.size
        at, run, out = 0, 0, []
        for c in words:
            to = nxt[at].get(c)
            while to is None and at:
                at = link[at]
                run = size[at]
                to = nxt[at].get(c)
            if to is None:
                run = 0
            else:
                at, run = to, run + 1
            out.append(run)
        return np.array(out, np.int64)


def _text_keys(w: S.Words) -> np.ndarray:
    """A hash of each text's word sequence."""
    place = np.arange(len(w.hashes), dtype=_U) - np.repeat(w.offsets[:-1], w.count()).astype(_U)
    return S.mix64(S.segment_sums(S.mix64(w.hashes ^ S.mix64(place + _U(77))), w.offsets) + w.count().astype(_U)).view(np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.slices(batch):
                w = S.words(*S.utf8(part.column("text")))
                columns = [part.column("doc_id"), pa.array(_text_keys(w)), pa.array(w.count())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_words"])

    return _rows(docs).mapInArrow(run, "doc_id long, text_key long, n_words long")


def anchors_of(w: S.Words, window: int = WINDOW, k: int = ANCHOR_WORDS) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, lo, hi): the windows lo..hi of a text have that anchor."""
    g = S.grams(w.hashes, k)
    span = window - k + 1
    n = len(g) - span + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, _U), z, z
    m = (g & _U(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=_U)
    size = 1
    while size * 2 <= span:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if span > size:
        m = np.minimum(m[: -(span - size)], m[span - size :])
    text = np.repeat(np.arange(len(w.offsets) - 1), w.count())[:n]
    starts = np.arange(n)
    inside = starts + window <= w.offsets[text + 1]
    starts, text = starts[inside], text[inside]
    at = (m[starts] & _U(0xFFFFFFFF)).astype(np.int64)
    if len(at) == 0:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, _U), z, z
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(new[1:], len(at)) - 1
    base = w.offsets[text[new]]
    return text[new], g[at[new]], starts[new] - base, starts[last] - base


def anchors(docs: DataFrame, window: int, k: int) -> DataFrame:
    """anchor, doc_id, text_key, lo, hi of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.slices(batch):
                w = S.words(*S.utf8(part.column("text")))
                text, anchor, lo, hi = anchors_of(w, window, k)
                columns = [anchor.view(np.int64), _text_keys(w)[text], lo.astype(np.int32), hi.astype(np.int32)]
                ids = part.column("doc_id").take(pa.array(text))
                arrays = [pa.array(columns[0]), ids, *[pa.array(c) for c in columns[1:]]]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "doc_id", "text_key", "lo", "hi"])

    return _rows(docs).mapInArrow(run, "anchor long, doc_id long, text_key long, lo int, hi int")


def _runs(lo: np.ndarray, hi: np.ndarray, window: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word ranges that the windows cover, merged; with their windows' ranges."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], hi[order]
    reach = np.maximum.accumulate(hi + window)
    heads = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
    ends = np.append(heads[1:], len(lo))
    return [(int(lo[a]), int(reach[b - 1]), lo[a:b], hi[a:b]) for a, b in zip(heads, ends, strict=True)]


_SEGMENT = "owner long, slice int, query boolean, doc_id long, text_key long, start int, words binary, lo array<int>, hi array<int>"
_FOUND = "doc_id long, text_key long, start int, size int, window long"


def _segments(window: int):
    """Live text of each document: as reference of its own anchors, as query of others'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["owner", "slice", "query", "doc_id", "text_key", "start", "words", "lo", "hi"]
        ints = pa.list_(pa.int32())
        types = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), ints, ints]
        for batch in batches:
            for part in S.slices(batch):
                w = S.words(*S.utf8(part.column("text")))
                keys = _text_keys(w)
                hashes = w.hashes >> _U(1)
                out: list[tuple] = []
                for i, (d, key, live) in enumerate(zip(*[part.column(c).to_pylist() for c in ("doc_id", "text_key", "live")], strict=True)):
                    if key != keys[i]:
                        continue
                    own = hashes[w.offsets[i] : w.offsets[i + 1]]
                    owners = np.array([x["owner"] for x in live], np.int64)
                    lo, hi = (np.array([x[c] for x in live], np.int64) for c in ("lo", "hi"))
                    slices = np.array([x["slices"] for x in live], np.int64)
                    for o in np.unique(owners):
                        mine = owners == o
                        n = int(slices[mine].max())
                        if o == d:
                            to = range(n)
                        else:
                            to = [int(S.mix64(np.array([key], np.int64).view(_U))[0] % _U(n))]
                        for a, b, los, his in _runs(lo[mine], hi[mine], window):
                            body = own[a:b].tobytes()
                            out += [(int(o), s, o != d, d, key, a, body, los.tolist(), his.tolist()) for s in to]
                columns = list(zip(*out, strict=True)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return run


def _matched(window: int, report: bool):
    """Rows come by owner and slice, reference first: build its automaton, stream the rest.

    Gives spans of words to remove and, with ``report``, the hashes of the
    windows that are not in the reference.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "start", "size", "window"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        at, automaton = None, Automaton()
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                group = (row["owner"], row["slice"])
                if group != at:
                    at, automaton = group, Automaton()
                words = np.frombuffer(row["words"], np.int64)
                if not row["query"]:
                    automaton.add(words.tolist())
                    continue
                run_of = automaton.statistics(words.tolist())
                ends = np.flatnonzero(run_of >= window)
                key = (row["doc_id"], row["text_key"])
                if len(ends):
                    cut = np.flatnonzero(np.diff(ends) > window)
                    first, last = np.concatenate([[0], cut + 1]), np.append(cut, len(ends) - 1)
                    for a, b in zip(ends[first] - window + 1, ends[last] + 1, strict=True):
                        out.append((*key, row["start"] + int(a), int(b - a), None))
                if report:
                    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(row["lo"], row["hi"], strict=True)]) - row["start"]
                    left = starts[run_of[starts + window - 1] < window]
                    if len(left):
                        whole = S.grams(words.view(_U), window)[left].view(np.int64)
                        out += [(*key, row["start"] + s, 1, h) for s, h in zip(left.tolist(), whole.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return run


def _against_owners(spark: SparkSession, docs: DataFrame, marks: DataFrame, window: int, slice_words: int, report: bool, name: str) -> DataFrame:
    """Spans and unmatched windows for ``marks``: anchor, doc_id, text_key, lo, hi."""
    owners = marks.groupBy("anchor").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("_last"))
    owners = owners.where("owner <> _last").select("anchor", "owner")
    live = materialize(spark, marks.join(owners, "anchor").select("owner", "doc_id", "text_key", "lo", "hi"), f"{name}-live")
    load = live.where("doc_id <> owner").groupBy("owner").agg(F.sum(F.col("hi") - F.col("lo") + window).alias("_words"))
    load = load.select("owner", F.ceil(F.col("_words") / F.lit(slice_words)).cast("int").alias("slices"))
    plan = live.join(load, "owner").groupBy("doc_id", "text_key")
    plan = plan.agg(F.collect_list(F.struct("owner", "lo", "hi", "slices")).alias("live"))
    cut = _rows(docs).join(plan, "doc_id").select("doc_id", "text_key", "live", "text").mapInArrow(_segments(window), _SEGMENT)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = cut.repartition(tasks, "owner", "slice").sortWithinPartitions("owner", "slice", "query", "doc_id", "text_key", "start")
    return materialize(spark, cut.mapInArrow(_matched(window, report), _FOUND), f"{name}-found")


def repeated_spans(
    spark: SparkSession, docs: DataFrame, window: int = WINDOW, anchor_words: int = ANCHOR_WORDS, slice_words: int = SLICE_WORDS
) -> tuple[DataFrame, DataFrame]:
    """(spans, later): word spans to remove as doc_id, text_key, start, size,
    for texts seen first; and doc_id, text_key of later copies, which go whole."""
    info = materialize(spark, sized(docs).where("doc_id is not null").where(F.col("n_words") >= window), "substring-sizes")
    first = info.groupBy("text_key").agg(F.min("doc_id").alias("_first"))
    seen = info.select("doc_id", "text_key").distinct().join(first, "text_key")
    later = materialize(spark, seen.where("doc_id > _first").select("doc_id", "text_key"), "substring-later")
    marks = anchors(docs.where(F.col("doc_id").isNotNull()), window, anchor_words)
    marks = marks.join(later, ["doc_id", "text_key"], "left_anti")
    marks = materialize(spark, marks, "substring-anchors")
    one = _against_owners(spark, docs, marks, window, slice_words, True, "substring-one")
    left = one.where("window is not null").select(
        F.col("window").alias("anchor"), "doc_id", "text_key", F.col("start").alias("lo"), F.col("start").alias("hi")
    )
    two = _against_owners(spark, docs, left, window, slice_words, False, "substring-two")
    spans = one.where("window is null").unionByName(two).select("doc_id", "text_key", "start", "size")
    return spans, later


_WORD = re.compile(WORD_PATTERN)


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text", "n_words", "n_removed"]
        for batch in batches:
            for part in S.slices(batch):
                texts, spans, wholes = (part.column(c).to_pylist() for c in ("text", "spans", "later"))
                own = _text_keys(S.words(*S.utf8(part.column("text"))))
                out: list[tuple[str, int, int]] = []
                for i, t in enumerate(texts):
                    words = _WORD.findall(t)
                    gone = np.zeros(len(words) + 1, np.int64)
                    if own[i] in (wholes[i] or ()):
                        gone[:] = 1
                    elif spans[i]:
                        for x in spans[i]:
                            if x["text_key"] == own[i]:
                                gone[x["start"]] += 1
                                gone[x["start"] + x["size"]] -= 1
                        gone = np.cumsum(gone)
                    kept = [x for x, g in zip(words, gone.tolist(), strict=False) if not g]
                    out.append((" ".join(kept), len(words), len(words) - len(kept)))
                kept_texts, n, removed = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(kept_texts, pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())], names
                )

    return run


def deduplicated(spark: SparkSession, docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """doc_id, text (kept words joined by one space), n_words, n_removed per document."""
    spans, later = repeated_spans(spark, docs, window, **options)
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("text_key", "start", "size")).alias("spans"))
    later = later.groupBy("doc_id").agg(F.collect_list("text_key").alias("later"))
    rows = _rows(docs).join(spans.join(later, "doc_id", "full"), "doc_id", "left")
    rows = rows.select("doc_id", "text", "spans", "later")
    return rows.mapInArrow(_kept(window), "doc_id long, text string, n_words long, n_removed long")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))

