"""Best-fit packing of documents into fixed-length sequences by a grouping
genetic algorithm.

Documents become pieces of at most ``capacity`` ids; only longer documents
are cut. A full piece is a sequence by itself. The rest is dealt at random
into shards of bounded size (their number follows the data); each shard's
grouping evolves on several islands, Spark tasks of their own, that send each
other their elites between epochs. What the shards leave under-filled is
dealt and packed once more.

A genome is a grouping: the bin of each item. Crossover injects whole
well-filled bins of one parent into the other, removes the other's bins that
hold any of their items, and best-fits the displaced items. Fitness is the
mean squared fill (more full bins, and so fewer).

Defined cases: null and empty texts are one piece (the end id); rows sharing
a doc_id are documents of their own; a null doc_id is kept; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.common import materialize
from starlane.llm.tokens import id_dtype, tokenized

CAPACITY = 2048
SHARD_ITEMS = 4000
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 10
# Bins below this share of the capacity are packed anew in the second round.
LEFTOVER_FILL = 0.97

_ITEM = "struct<length:bigint,doc_id:bigint,piece:int,start:bigint,ids_crc32:bigint,tag:bigint>"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, tag, piece, start, length, ids_crc32 of each piece; with ``with_ids`` also its ids.

    ``tag`` tells apart documents that share a doc_id by their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for d, w, x in zip(*[batch.column(c) for c in ("doc_id", "width", "ids")], strict=True):
                ids = np.frombuffer(x.as_buffer(), id_dtype(w.as_py())).astype("<u4")
                tag = zlib.adler32(ids.tobytes())
                for k, at in enumerate(range(0, len(ids), capacity)):
                    some = ids[at : at + capacity].tobytes()
                    out.append((d.as_py(), tag, k, at, len(some) // 4, zlib.crc32(some), some))
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["doc_id", "tag", "piece", "start", "length", "ids_crc32", "ids"]
            keep = 7 if with_ids else 6
            yield pa.RecordBatch.from_arrays(arrays[:keep], names[:keep])

    schema = "doc_id long, tag long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return tokenized(docs, tokenizer).mapInArrow(run, schema)


class _Open:
    """Open bins by room left; best fit is the lowest set bit from the length up."""

    def __init__(self, capacity: int) -> None:
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0

    def add(self, bin_: int, room: int) -> None:
        self.by_room[room].append(bin_)
        self.rooms |= 1 << room

    def take(self, length: int) -> tuple[int, int] | None:
        """The fullest bin that ``length`` fits in, and its room."""
        fitting = self.rooms >> length
        if not fitting:
            return None
        room = length + (fitting & -fitting).bit_length() - 1
        bins = self.by_room[room]
        found = bins.pop()
        if not bins:
            self.rooms ^= 1 << room
        return found, room


def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, capacity: int) -> None:
    """Put the items ``order`` into the bins of ``bins`` (-1: none yet), in place."""
    placed = bins >= 0
    n = int(bins.max()) + 1 if len(bins) else 0
    fill = np.bincount(bins[placed], weights=lengths[placed], minlength=n).astype(int)
    open_ = _Open(capacity)
    for b in np.flatnonzero((fill > 0) & (fill < capacity)):
        open_.add(int(b), int(capacity - fill[b]))
    for i in order.tolist():
        length = int(lengths[i])
        found = open_.take(length)
        if found is None:
            b, room = n, capacity
            n += 1
        else:
            b, room = found
        bins[i] = b
        if room > length:
            open_.add(b, room - length)


def _dense(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    fill = np.bincount(bins, weights=lengths) / capacity
    return float(np.mean(fill * fill))


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with some of ``b``'s fullest bins injected whole."""
    fill = np.bincount(b, weights=lengths)
    good = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, len(good) // 5), replace=False)] = True
    injected = chosen[b]
    hit = np.zeros(int(a.max()) + 1, bool)
    hit[a[injected]] = True
    displaced = np.flatnonzero(hit[a] & ~injected)
    child = np.where(injected, b + int(a.max()) + 1, a)
    child[displaced] = -1
    kept = child >= 0
    child[kept] = _dense(child[kept])
    best_fit(lengths, displaced[np.argsort(-lengths[displaced], kind="stable")], child, capacity)
    return _dense(child)


def mutate(a: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` without its emptiest bin and a few others, their items best-fitted in random order."""
    fill = np.bincount(a, weights=lengths)
    gone = np.zeros(len(fill), bool)
    gone[np.argmin(fill)] = True
    gone[rng.integers(0, len(fill), max(1, len(fill) // 50))] = True
    loose = np.flatnonzero(gone[a])
    child = a.copy()
    child[loose] = -1
    kept = child >= 0
    child[kept] = _dense(child[kept])
    best_fit(lengths, rng.permutation(loose), child, capacity)
    return _dense(child)


def evolve(lengths: np.ndarray, elites: list[np.ndarray], capacity: int, seed: int, population: int, generations: int) -> np.ndarray:
    """The best grouping after ``generations`` from ``elites`` and fresh best fits.

    Stops at the fewest bins possible, ceil(total / capacity).
    """
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // capacity)
    pool = [(fitness(e, lengths, capacity), e) for e in elites]
    while len(pool) < population:
        # Decreasing first fit order, later ones with the lengths blurred.
        blur = lengths * (1 + (0.1 * rng.random(len(lengths)) if pool else 0))
        new = np.full(len(lengths), -1, np.int32)
        best_fit(lengths, np.argsort(-blur, kind="stable"), new, capacity)
        new = _dense(new)
        pool.append((fitness(new, lengths, capacity), new))
        if new.max() + 1 <= least:
            return new
    pool.sort(key=lambda x: -x[0])
    for _ in range(generations):
        if pool[0][1].max() + 1 <= least:
            break
        i, j = np.sort(rng.choice(len(pool), 2, replace=False))
        child = crossover(pool[i][1], pool[j][1], lengths, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, lengths, capacity, rng)
        pool[-1] = max(pool[-1], (fitness(child, lengths, capacity), child), key=lambda x: x[0])
        pool.sort(key=lambda x: -x[0])
    return pool[0][1]


def _island(capacity: int, population: int, generations: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                elites = [np.array(e, np.int32) for e in row["elites"]]
                seed = row["shard"] * 1009 + row["island"] * 31 + epoch
                best = evolve(lengths, elites, capacity, seed, population, generations)
                columns = [[row["shard"]], [row["island"]], [best], [fitness(best, lengths, capacity)]]
                types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.float64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["shard", "island", "bins", "fitness"])

    return run


def _evolved(
    spark: SparkSession, shards: DataFrame, capacity: int, islands: int, epochs: int, population: int, generations: int
) -> DataFrame:
    """shard, bins: the best grouping of each shard over its islands."""
    lengths = F.transform("items", lambda x: x["length"])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = shards.select("shard", lengths.alias("lengths"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = base.withColumn("elites", F.array().cast("array<array<int>>"))
    for epoch in range(epochs):
        spread = state.select("shard", "island", "lengths", "elites").repartition(tasks, "shard", "island")
        best = spread.mapInArrow(_island(capacity, population, generations, epoch), "shard long, island int, bins array<int>, fitness double")
        best = materialize(spark, best, "pack-epoch")
        if epoch + 1 < epochs:
            # Ring migration: an island goes on from its own elite and its neighbour's.
            own = best.select("shard", "island", F.col("bins").alias("own"))
            sent = best.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("bins").alias("sent"))
            state = base.join(own, ["shard", "island"]).join(sent, ["shard", "island"])
            state = state.withColumn("elites", F.array("own", "sent"))
    top = best.groupBy("shard").agg(F.max(F.struct("fitness", -F.col("island"), "bins")).alias("top"))
    return top.select("shard", F.col("top.bins").alias("bins"))


def _round(spark: SparkSession, items: DataFrame, number: int, capacity: int, shard_items: int, options: dict) -> DataFrame:
    """items with shard, bin and fill of their bin."""
    n = items.count()
    shards = max(1, -(-n // shard_items))
    names = ["length", "doc_id", "piece", "start", "ids_crc32", "tag"]
    # The row's place in the written table makes repeated rows go apart.
    row = F.xxhash64("doc_id", "tag", "piece", F.lit(number), F.monotonically_increasing_id())
    dealt = items.withColumn("shard", F.pmod(row, F.lit(shards)))
    grouped = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct(*names)), asc=False).alias("items"))
    grouped = materialize(spark, grouped, "pack-shards")
    bins = _evolved(spark, grouped, capacity, **options)
    both = grouped.join(bins, "shard").select("shard", F.explode(F.arrays_zip("items", "bins")).alias("x"))
    both = both.select("shard", F.col("x.bins").alias("bin"), *[F.col(f"x.items.{c}").alias(c) for c in names])
    return materialize(spark, both, "pack-round")


def _placed(rows: DataFrame, number: int) -> DataFrame:
    """Sequence numbers and offsets: a bin's items are summed up in its row."""
    names = ["length", "doc_id", "piece", "start", "ids_crc32", "tag"]
    bins = rows.groupBy("shard", "bin").agg(F.sort_array(F.collect_list(F.struct(*names)), asc=False).alias("items"))
    lengths = F.transform("items", lambda x: x["length"])
    offsets = F.transform("items", lambda x, i: F.aggregate(F.slice(lengths, 1, i), F.lit(0).cast("long"), lambda a, y: a + y))
    flat = bins.select("shard", "bin", F.explode(F.arrays_zip("items", offsets.alias("offset"))).alias("x"))
    sequence = F.col("shard") * (1 << 24) + F.col("bin") * 4 + number
    return flat.select(*[F.col(f"x.items.{c}").alias(c) for c in names], sequence.alias("sequence_id"), F.col("x.offset").alias("offset"))


def pack(
    spark: SparkSession,
    piece_rows: DataFrame,
    capacity: int = CAPACITY,
    shard_items: int = SHARD_ITEMS,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    population: int = POPULATION,
    generations: int = GENERATIONS,
) -> DataFrame:
    """``piece_rows`` (see ``pieces``) with sequence_id and offset."""
    options = {"islands": islands, "epochs": epochs, "population": population, "generations": generations}
    names = ["length", "doc_id", "piece", "start", "ids_crc32", "tag"]
    whole = piece_rows.where(F.col("length") == capacity)
    # Numbers of full pieces are negative and count rows of a partition apart.
    whole = whole.select(*names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = _round(spark, piece_rows.where(F.col("length") < capacity), 0, capacity, shard_items, options)
    fills = first.groupBy("shard", "bin").agg((F.sum("length") >= LEFTOVER_FILL * capacity).alias("good"))
    first = materialize(spark, first.join(fills, ["shard", "bin"]), "pack-fills")
    second = _round(spark, first.where(~F.col("good")).select(*names), 1, capacity, shard_items, options)
    done = _placed(first.where("good"), 0).unionByName(_placed(second, 1)).unionByName(whole)
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "tag")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    capacity = options.get("capacity", CAPACITY)
    return pack(spark, materialize(spark, pieces(docs, tokenizer, capacity), "pack-pieces"), **options)
