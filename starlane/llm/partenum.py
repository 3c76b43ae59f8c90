"""N-gram Jaccard join by PartEnum signatures.

A document is its set of distinct word shingles. Sizes fall into bands in
which the largest size is 1/threshold of the smallest; sets that can link are
in one band or in neighbouring ones, so every set signs for its own band and
for the next. For a band whose largest size is u, linked sets differ in at
most k = 2u(1-t)/(1+t) shingles: with the shingle domain cut into n > k parts,
at least n - k parts hold exactly the same shingles of both. The signature of
a part is a hash of the shingles a set has in it, so linked sets share one.

That holds for any part of the domain: linked sets differ in at most k of its
shingles. The first partition leaves out shingles that are frequent over all
documents (shared passages, common lines), which would sign for unlike sets.
Empty parts sign nothing. A set with fewer than n - k empty parts shares a
signature with anything it links to; the others sign for further, independent
partitions of the whole domain, and at last for every single shingle.

Equal sets are one node. A signature's nodes are compared with one of them
first, its hub (a star, not all pairs). Where several components remain in a
group, its nodes are compared across components, in blocks inside tasks: a
parity bitmap of each set bounds the difference from below, and only pairs
that pass it leave the task, to be verified on the full sets. No candidate is
capped. Groups are counted by aggregates, never by a window over one of them.

Defined cases: null and empty texts have no shingles and link with nothing; a
text shorter than a shingle has its words as the only one; rows with a null
doc_id are returned with a null component, as no id could name it; repeated
rows come back as often as they occur; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm import shingles as S
from starlane.llm.common import materialize, some_ids, text_or_empty
from starlane.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80
# Independent partitions a set with many empty parts tries before its shingles.
PARTITIONS = 6
# Groups of up to so many nodes give their pairs; larger ones are compared in
# blocks of about so many nodes.
SMALL_GROUP = 16
BLOCK_NODES = 500
# Frequent shingles: in so many of so many documents. They only steer which
# signatures are made; the links found are the same for any choice.
PER_DOCS = 10_000
FREQUENT = 5
MOST_FREQUENT = 1_000_000
# All documents are counted, in runs of about so many shingles.
COUNTED = 2_000_000

_U = np.uint64


def bands(largest: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest size of each band, up to one above ``largest``."""
    low, high = [1], [100 // percent]
    while high[-1] < largest:
        low.append(high[-1] + 1)
        high.append(low[-1] * 100 // percent)
    low.append(high[-1] + 1)
    high.append(low[-1] * 100 // percent)
    return np.array(low), np.array(high)


def most_apart(high: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many shingles linked sets of at most ``high`` shingles can differ in."""
    return 2 * high * (100 - percent) // (100 + percent)


def spare(apart: np.ndarray) -> np.ndarray:
    """Parts beyond k + 1: as many may be empty."""
    return (apart * 13 + 99) // 100 + (apart > 0)


def _parts(hashes: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    return ((hashes >> _U(32)) * np.asarray(n).astype(_U)) >> _U(32)


def signatures(
    sets: np.ndarray, off: np.ndarray, percent: int = PERCENT, frequent: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(set index, signature) of all sets.

    ``sets`` holds each set's hashes in ascending order, ``off`` their ranges;
    ``frequent``, ascending, is left out of the first partition.
    """
    size = np.diff(off)
    if len(sets) == 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    low, high = bands(int(size.max()), percent)
    apart = most_apart(high, percent)
    n_parts = apart + 1 + spare(apart)
    own = np.maximum(np.searchsorted(low, size, "right") - 1, 0)
    who = np.repeat(np.arange(len(size)), size)
    rare = np.ones(len(sets), bool)
    if frequent is not None and len(frequent):
        at = np.minimum(np.searchsorted(frequent, sets), len(frequent) - 1)
        rare = frequent[at] != sets
    owners, signed = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    for ahead in (0, 1):
        tag = own + ahead
        todo = np.flatnonzero(size > 0)
        for turn in range(PARTITIONS + 1):
            if len(todo) == 0:
                break
            if turn == 0:
                h, w = sets[rare], who[rare]
            else:
                inside = np.isin(who, todo)
                h, w = S.mix64(sets[inside] + S.mix64(np.array([turn], _U))), who[inside]
                order = np.lexsort((h, w))
                h, w = h[order], w[order]
            part = _parts(h, n_parts[tag[w]]) if turn < PARTITIONS else np.arange(len(h)).astype(_U)
            new = np.concatenate([[True], (part[1:] != part[:-1]) | (w[1:] != w[:-1])])[: len(h)]
            at = np.flatnonzero(new)
            name = part[at] if turn < PARTITIONS else np.zeros(len(at), _U)
            label = S.mix64((tag[w[at]].astype(_U) << _U(40)) + (_U(turn) << _U(32)) + name + _U(1))
            if len(at):
                owners.append(w[at])
                signed.append(S.mix64(np.add.reduceat(S.mix64(h + _U(0x51ED270B)), at) ^ label))
            filled = np.bincount(w[at], minlength=len(size))[todo]
            # Empty parts are fewer than those that linked sets share at least.
            todo = todo[filled <= apart[tag[todo]]]
    return np.concatenate(owners), np.concatenate(signed)


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the shingles in each of 2^j >= 4 * size buckets: two sets differ
    in at least as many shingles as their bitmaps in bits, and in hardly more."""
    n = max(64, 4 << int(len(hashes) - 1).bit_length()) if len(hashes) else 64
    bucket = (S.mix64(hashes) & _U(n - 1)).astype(np.int64)
    return np.packbits((np.bincount(bucket, minlength=n) & 1).astype(np.uint8), bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets_of(part: pa.RecordBatch, words: int) -> tuple[np.ndarray, np.ndarray]:
    return S.shingle_sets(S.words(*S.utf8(part.column("text")), lower=True), words)


def _prints(sets: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    return S.mix64(S.segment_sums(S.mix64(sets), off)), S.mix64(S.segment_sums(S.mix64(sets ^ _U(0xA5A5A5A5A5A5A5A5)), off))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def _repeated(held: list[np.ndarray]) -> pa.RecordBatch:
    """Rows of ``described`` for the shingles that are in two or more of these sets."""
    found, seen = np.unique(np.concatenate(held), return_counts=True)
    found, seen = found[seen > 1], seen[seen > 1]
    none = [pa.nulls(len(found), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
    columns = [none[0], none[1], pa.array(found.view(np.int64)), none[2], none[3], pa.array(seen)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node", "check", "bitmap", "seen"])


def described(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, node and check (hashes of the set), bitmap of each row,
    with a null ``seen``; and between them a row for each shingle (``node``) that
    ``seen`` documents of a run have, two or more: runs of about COUNTED shingles
    inside a task, so the counts are of all documents and their memory is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for part in S.slices(batch):
                sets, off = _sets_of(part, words)
                node, check = (x.view(np.int64) for x in _prints(sets, off))
                maps = [bitmap(sets[a:b]) for a, b in zip(off, off[1:], strict=False)]
                columns = [pa.array(np.diff(off)), pa.array(node), pa.array(check), pa.array(maps, pa.binary()), pa.nulls(len(node), pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_shingles", "node", "check", "bitmap", "seen"])
                held.append(sets)
                if sum(map(len, held)) >= COUNTED:
                    yield _repeated(held)
                    held = []
        if held:
            yield _repeated(held)

    return _rows(docs).mapInArrow(run, "doc_id long, n_shingles long, node long, check long, bitmap binary, seen long")


def frequent_shingles(info: DataFrame) -> np.ndarray:
    """Hashes, ascending, of the shingles in FREQUENT of PER_DOCS documents or
    more; at most MOST_FREQUENT, the most frequent ones.

    A run's shingles of one document only are left out of the sum: it is less
    than the true count by the number of runs at most.
    """
    least = max(FREQUENT, info.where("seen is null").count() * FREQUENT // PER_DOCS)
    counts = info.where("seen is not null").groupBy("node").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= least)
    rows = counts.orderBy(F.col("seen").desc(), "node").limit(MOST_FREQUENT)
    return np.sort(rows.select("node").toArrow().column("node").to_numpy().astype(np.int64).view(_U))


def signed(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, frequent=None) -> DataFrame:
    """signature, node rows; a task signs equal sets once. ``frequent``: a broadcast array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for part in S.slices(batch):
                sets, off = _sets_of(part, words)
                node = _prints(sets, off)[0].view(np.int64)
                new = np.zeros(len(node), bool)
                for i, x in enumerate(node.tolist()):
                    if x not in done:
                        done.add(x)
                        new[i] = True
                size = np.where(new, np.diff(off), 0)
                sets = sets[np.repeat(new, np.diff(off))]
                offsets = np.concatenate([[0], np.cumsum(size)])
                owner, sig = signatures(sets, offsets, percent, None if frequent is None else frequent.value)
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(node[owner])], ["signature", "node"])

    return _rows(docs).mapInArrow(run, "signature long, node long")


def _pruned(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets whose sizes and bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [batch.column(c).to_numpy() for c in ("a_n", "b_n")]
            apart = (n[0] + n[1]) * (100 - percent) // (100 + percent)
            maps = [batch.column(c) for c in ("a_map", "b_map")]
            near = [bits_apart(x.as_buffer(), y.as_buffer()) <= k for x, y, k in zip(*maps, apart.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    fits = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    return pairs.where(fits).mapInArrow(run, "a long, b long")


def linked(spark: SparkSession, docs: DataFrame, sets: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs of nodes, the links (a, b) between sets, verified on the full sets."""
    left, right = (
        sets.select(*[F.col(c).alias(f"{s}_{n}") for c, n in (("node", "node"), ("set", "id"), ("n_shingles", "n"), ("bitmap", "map"))])
        for s in "ab"
    )
    both = pairs.join(left, pairs["a"] == left["a_node"]).join(right, pairs["b"] == right["b_node"]).where("a_id <> b_id")
    both = both.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "a_n", "b_n", "a_map", "b_map")
    near = materialize(spark, _pruned(both, percent), "ngram-near")
    wanted = near.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    wanted = materialize(spark, sets.join(wanted, "set", "left_semi").select("set", "set_id", F.col("node").alias("set_node"), F.col("check").alias("set_check")), "ngram-wanted")
    if wanted.limit(1).count() == 0:
        return near.limit(0)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in S.slices(batch):
                found, off = _sets_of(part, words)
                prints = [x.view(np.int64) for x in _prints(found, off)]
                # Rows may share the doc_id but not the text, and sets the doc_id.
                same = (prints[0] == part.column("set_node").to_numpy()) & (prints[1] == part.column("set_check").to_numpy())
                body = [found[off[i] : off[i + 1]].tobytes() for i in np.flatnonzero(same)]
                ids = part.column("set").filter(pa.array(same))
                yield pa.RecordBatch.from_arrays([ids, pa.array(body, pa.binary())], ["set", "hashes"])

    rows = _rows(docs)
    rows = rows.join(some_ids(wanted, "set_id"), rows["doc_id"] == wanted["set_id"]).select("set", "text", "set_node", "set_check")
    hashes = rows.mapInArrow(full, "set long, hashes binary")
    hashes = materialize(spark, hashes, "ngram-sets").dropDuplicates(["set"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both_n = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both_n >= percent * (len(p) + len(q) - both_n))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = hashes.select(F.col("set").alias("a"), F.col("hashes").alias("x"))
    y = hashes.select(F.col("set").alias("b"), F.col("hashes").alias("y"))
    return materialize(spark, near.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), "ngram-links")


def _folded(maps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, folded to ``size`` bytes."""
    out = np.empty((len(maps), size // 8), _U)
    for i, m in enumerate(maps):
        x = np.frombuffer(m, _U)
        while x.nbytes > size:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        out[i] = x
    return out


def _block_pairs(percent: int):
    """Pairs of two blocks of a group that lie in different components and that
    sizes and bitmaps allow to link: folded to one size first, then whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = row["x"], row["y"]
                size = min(len(m["bitmap"]) for m in x + y)
                bits = [_folded([m["bitmap"] for m in side], size) for side in (x, y)]
                n, component, node = ([np.array([m[c] for m in side], np.int64) for side in (x, y)] for c in ("n", "component", "node"))
                for i in range(len(x)):
                    apart = np.bitwise_count(bits[0][i] ^ bits[1]).sum(axis=1)
                    most = (n[0][i] + n[1]) * (100 - percent) // (100 + percent)
                    near = (apart <= most) & (component[1] != component[0][i])
                    near &= 100 * np.minimum(n[0][i], n[1]) >= percent * np.maximum(n[0][i], n[1])
                    whole = [j for j in np.flatnonzero(near).tolist() if bits_apart(x[i]["bitmap"], y[j]["bitmap"]) <= most[j]]
                    if whole:
                        a, b = np.minimum(node[1][whole], node[0][i]), np.maximum(node[1][whole], node[0][i])
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _hub_pairs(spark: SparkSession, entries: DataFrame) -> DataFrame:
    """Pairs of each node with the hub of a group it is in: the node that meets
    most others over all its groups. Of a family of near copies that is the
    text they were made from, which links them all.

    Groups are counted by aggregates written as tables, which the entries are
    joined with: Spark can split such a join where one group is large.
    """
    sized = materialize(spark, entries.groupBy("key").agg(F.count(F.lit(1)).alias("met")), "ngram-sized")
    degree = entries.join(sized, "key").groupBy("node").agg(F.sum("met").alias("degree"))
    degree = materialize(spark, degree, "ngram-degree")
    hubs = entries.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node")).alias("hub"))
    hubs = materialize(spark, hubs.select("key", F.col("hub.node").alias("hub")), "ngram-hubs")
    return entries.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def _open_pairs(spark: SparkSession, entries: DataFrame, sets: DataFrame, links: DataFrame, percent: int, block_nodes: int) -> DataFrame:
    """Pairs of nodes (a, b) that share a signature, lie in different components
    of ``links`` and may link."""
    labels = components(spark, links)
    of = sets.join(labels, sets["set"] == labels["node"], "left").select(
        sets["node"].alias("n"), F.coalesce("label", "set").alias("component"), "n_shingles", "bitmap"
    )
    named = materialize(spark, entries.join(of.select("n", "component"), entries["node"] == of["n"]).select("key", "node", "component"), "ngram-named")
    ends = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("nodes"))
    ends = materialize(spark, ends.where("low <> high").select("key", "nodes"), "ngram-ends")
    named = materialize(spark, named.join(ends, "key"), "ngram-open")
    # Small groups give their pairs, which recur from signature to signature;
    # larger ones are compared in blocks.
    small = named.where(F.col("nodes") <= SMALL_GROUP)
    other = small.select("key", F.col("node").alias("b"), F.col("component").alias("_c"))
    few = small.withColumnRenamed("node", "a").join(other, "key").where("a < b and component <> _c").select("a", "b").distinct()
    named = named.where(F.col("nodes") > SMALL_GROUP)
    blocks = F.ceil(F.col("nodes") / F.lit(block_nodes))
    full = named.join(of.drop("component"), named["node"] == of["n"])
    full = full.withColumn("block", F.pmod(F.xxhash64("node", "key"), blocks).cast("int"))
    member = F.struct("node", "component", F.col("n_shingles").alias("n"), "bitmap")
    full = materialize(spark, full.groupBy("key", "block").agg(F.collect_list(member).alias("members")), "ngram-blocks")
    x = full.select("key", F.col("block").alias("i"), F.col("members").alias("x"))
    y = full.select("key", F.col("block").alias("j"), F.col("members").alias("y"))
    pairs = x.join(y, "key").where("i <= j").select("x", "y").mapInArrow(_block_pairs(percent), "a long, b long")
    return few.unionByName(pairs).distinct()


def join(
    spark: SparkSession, docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, block_nodes: int = BLOCK_NODES
) -> DataFrame:
    """doc_id, n_shingles, component_id of each document."""
    described_rows = materialize(spark, described(docs, words), "ngram-info")
    info = described_rows.where("seen is null").drop("seen")
    named = info.where("n_shingles > 0 and doc_id is not null")
    sets = named.groupBy("node", "check").agg(
        F.min("doc_id").alias("set_id"), F.first("n_shingles").alias("n_shingles"), F.first("bitmap").alias("bitmap")
    )
    # set_id is not a key: two texts may share it.
    sets = materialize(spark, sets.withColumn("set", F.monotonically_increasing_id()), "ngram-distinct")

    known = docs.where(F.col("doc_id").isNotNull())
    frequent = spark.sparkContext.broadcast(frequent_shingles(described_rows))
    rows = signed(known, words, percent, frequent).withColumnRenamed("signature", "key")
    # Most signatures are of one set: signing again costs less than a table of all.
    met = rows.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    met = materialize(spark, met.select("key"), "ngram-met")
    entries = materialize(spark, rows.join(some_ids(met, "key"), "key", "left_semi").distinct(), "ngram-entries")
    # Sets that differ but share the 64-bit node hash (not the check) are a pair too.
    clash = sets.groupBy("node").count().where("count > 1").select(F.col("node").alias("a"), F.col("node").alias("b"))
    star = _hub_pairs(spark, entries).unionByName(clash)
    links = linked(spark, docs, sets, star, words, percent)
    more = _open_pairs(spark, entries, sets, links, percent, block_nodes)
    links = links.unionByName(linked(spark, docs, sets, more, words, percent))

    labels = components(spark, links)
    named_sets = sets.join(labels, sets["set"] == labels["node"], "left").select(
        sets["node"].alias("s_node"), F.col("check").alias("s_check"), "set_id", F.coalesce("label", "set").alias("label")
    )
    lowest = named_sets.groupBy("label").agg(F.min("set_id").alias("component"))
    named_sets = named_sets.join(lowest, "label").select("s_node", "s_check", "component")
    out = info.join(named_sets, (info["node"] == named_sets["s_node"]) & (info["check"] == named_sets["s_check"]), "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component"))
    return materialize(spark, out.select("doc_id", "n_shingles", component.alias("component_id")), "ngram-result")


def one_of_each(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component: the one with its id.

    Of rows that share an id, those in the component named by it stay once.
    Rows without an id stay.
    """
    found = join(spark, docs, **options)
    stay = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    stay = materialize(spark, stay, "ngram-stay")
    rows = docs.join(stay, docs["doc_id"].cast("long") == stay["__id"]).select(*[docs[c] for c in docs.columns])
    if stay.where("__n > 1").limit(1).count():
        rows = rows.dropDuplicates(["doc_id"])
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))
