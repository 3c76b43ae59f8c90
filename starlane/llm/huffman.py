"""Token ids in canonical length-limited Huffman code.

Layout of a coded corpus (a folder): ``code`` holds the code lengths, one row
per id in use; ``blocks`` holds independent blocks in ascending doc_id order,
each with the documents it covers, the coded bits and the bit offset of every
``STEP``-th id, so that a block decodes from many points at once; ``index``
holds the number of ids before each part of the block files. Bits are read
from the highest down.

The code is canonical: codes of one length are consecutive in order of id, so
the lengths alone define it. Lengths come from package-merge over the global
counts (one row per vocabulary id, the only data the driver sees).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlane.llm.common import materialize, settings
from starlane.llm.shingles import utf8
from starlane.llm.tokens import id_dtype, tokenized
from starlane.session import scratch_path

MAX_BITS = 20
STEP = 128
# Ids a block holds at least, unless its part of the corpus ends; documents
# are never split over blocks.
BLOCK_IDS = 1 << 16

_BLOCK = (
    "part int, number int, first long, n_ids long, doc_ids array<long>, doc_lengths array<long>, steps array<long>, bits binary"
)


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge).

    ``counts`` are positive, one per symbol. Ties are broken by position, so
    equal counts give equal codes everywhere.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols need more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    # Level by level: merge the leaves with the pairs of the level below.
    # A level keeps, for each of its items, the number of leaves among the
    # items up to it; leaves are taken smallest first.
    levels, weights = [], leaves
    levels.append(np.arange(1, n + 1))
    for _ in range(max_bits - 1):
        pairs = weights[0 : len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        weights = both[at]
        levels.append(np.cumsum(at < n))
    depth = np.zeros(n + 1, np.int64)
    take = 2 * n - 2
    for held in reversed(levels):
        own = int(held[take - 1]) if take else 0
        depth[0] += 1
        depth[own] -= 1
        take = 2 * (take - own)
    lengths = np.empty(n, np.int64)
    lengths[order] = np.cumsum(depth[:-1])
    return lengths


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by (length, id), each one above the one before."""
    order = np.lexsort((ids, lengths))
    sizes = lengths[order]
    # Codes scaled to the longest length are prefix sums of 2^(L - length).
    top = int(sizes[-1]) if len(sizes) else 0
    scaled = np.concatenate([[0], np.cumsum(np.int64(1) << (top - sizes))])[:-1]
    codes = np.empty(len(ids), np.int64)
    codes[order] = scaled >> (top - sizes)
    return codes


class Code:
    """Tables of a canonical code for encoding and decoding."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids, self.lengths = ids.astype(np.int64), lengths.astype(np.int64)
        codes = canonical_codes(self.ids, self.lengths)
        size = int(self.ids.max()) + 1 if len(ids) else 0
        self.code = np.zeros(size, np.uint64)
        self.size = np.zeros(size, np.uint64)
        self.code[self.ids] = codes.astype(np.uint64)
        self.size[self.ids] = self.lengths.astype(np.uint64)
        self.top = int(self.lengths.max()) if len(ids) else 1
        self._table: tuple[np.ndarray, np.ndarray] | None = None

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length by the next ``top`` bits."""
        if self._table is None:
            order = np.lexsort((self.ids, self.lengths))
            span = np.int64(1) << (self.top - self.lengths[order])
            self._table = (
                np.resize(np.repeat(self.ids[order], span).astype(np.uint32), 1 << self.top),
                np.resize(np.repeat(self.lengths[order], span).astype(np.uint8), 1 << self.top),
            )
        return self._table

    def encode(self, ids: np.ndarray, step: int = STEP) -> tuple[bytes, np.ndarray]:
        """The coded bits, and the bit offset of every ``step``-th id."""
        sizes = self.size[ids]
        ends = np.cumsum(sizes, dtype=np.uint64)
        if len(ids) == 0:
            return b"", np.zeros(0, np.int64)
        starts = ends - sizes
        # Each code lies in two neighbouring 32-bit words; codes that share a
        # word have no common bit, so sums put the words together.
        word = (starts >> np.uint64(5)).astype(np.int64)
        placed = self.code[ids] << (np.uint64(64) - (starts & np.uint64(31)) - sizes)
        out = np.zeros(int(word[-1]) + 2, np.uint64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        out[word[first]] += np.add.reduceat(placed >> np.uint64(32), first)
        out[word[first] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), first)
        n_bytes = (int(ends[-1]) + 7) // 8
        return out.astype(">u4").tobytes()[:n_bytes], starts[::step].astype(np.int64)

    def decode(self, bits: bytes, steps: np.ndarray, n: int, step: int = STEP) -> np.ndarray:
        """``n`` ids, from all checkpoints side by side."""
        if n == 0:
            return np.zeros(0, np.uint32)
        ids, sizes = self.table()
        data = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint64)
        at = steps.astype(np.uint64)
        out = np.zeros((len(steps), step), np.uint32)
        shift, mask = np.uint64(40 - self.top), np.uint64((1 << self.top) - 1)
        in_last = n - (len(steps) - 1) * step  # the last lane may end early
        for k in range(step):
            b = (at >> np.uint64(3)).astype(np.int64)
            seen = (data[b] << np.uint64(32)) | (data[b + 1] << np.uint64(24)) | (data[b + 2] << np.uint64(16))
            seen |= (data[b + 3] << np.uint64(8)) | data[b + 4]
            key = ((seen >> (shift - (at & np.uint64(7)))) & mask).astype(np.int64)
            out[:, k] = ids[key]
            at += sizes[key].astype(np.uint64)
            if k + 1 >= in_last:
                at[-1] = np.uint64(steps[-1])
        return out.reshape(-1)[:n]


def id_counts(tokens: DataFrame) -> DataFrame:
    """id, n: how often each id occurs, summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for width in set(batch.column("width").to_pylist()):  # one to a tokenizer
                some = batch.filter(pc.equal(batch.column("width"), width))
                own = np.bincount(np.frombuffer(utf8(some.column("ids"))[0].tobytes(), id_dtype(width)), minlength=len(total))
                own[: len(total)] += total
                total = own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return tokens.select("width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _blocks(ids: np.ndarray, lengths: np.ndarray, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, lengths)
        part, number, first = None, 0, 0
        docs: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal number, first, held
            bits, steps = code.encode(np.concatenate(parts).astype(np.int64))
            columns = [[part], [number], [first], [held], [list(docs)], [[len(p) for p in parts]], [steps], [bits]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["part", "number", "first", "n_ids", "doc_ids", "doc_lengths", "steps", "bits"],
            )
            number, first, held = number + 1, first + held, 0
            docs.clear()
            parts.clear()
            return out

        for batch in batches:
            columns = [batch.column(c) for c in ("part", "doc_id", "width", "ids")]
            for p, d, w, x in zip(*columns, strict=True):
                if p.as_py() != part:
                    if held:
                        yield block()
                    part, number, first = p.as_py(), 0, 0
                docs.append(d.as_py())
                parts.append(np.frombuffer(x.as_buffer(), id_dtype(w.as_py())).copy())
                held += len(parts[-1])
                if held >= block_ids:
                    yield block()
        if held:
            yield block()

    return run


def write_corpus(
    spark: SparkSession, docs: DataFrame, tokenizer: str, path: str, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS
) -> None:
    """Encode every document of ``docs`` and write the coded corpus to ``path``."""
    tokens = materialize(spark, tokenized(docs, tokenizer), "huffman-ids")
    counts = sorted((r["id"], r["n"]) for r in id_counts(tokens).collect())  # a row per vocabulary id at most
    ids = np.array([c[0] for c in counts], np.int64)
    lengths = code_lengths(np.array([c[1] for c in counts], np.int64), max_bits)
    # Range partitions in doc_id order; a tie of doc_id keeps to one order.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "ids"
    )
    ranged = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "width", "ids")
    conf = {
        "spark.sql.parquet.compression.codec": "uncompressed",
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with settings(spark, conf):
        code = spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist(), strict=True)), "id long, bits int")
        code.coalesce(1).write.mode("overwrite").parquet(f"{path}/code")
        ranged.mapInArrow(_blocks(ids, lengths, block_ids), _BLOCK).write.mode("overwrite").parquet(f"{path}/blocks")
        blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
        per_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))  # a row per part
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        index = per_part.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
        index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def _read_code(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted((r["id"], r["bits"]) for r in spark.read.schema("id long, bits int").parquet(f"{path}/code").collect())
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def read_corpus(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each coded document, decoded from
    the files; with ``with_ids`` also its ids."""
    ids, lengths = _read_code(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, lengths)
        for batch in batches:
            for row in batch.to_pylist():
                found = code.decode(row["bits"], np.array(row["steps"], np.int64), row["n_ids"]).astype("<u4")
                sizes = np.array(row["doc_lengths"], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                raw = [found[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["base"] + row["first"] + offsets[:-1], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in raw], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    index = spark.read.schema("part int, base long").parquet(f"{path}/index")
    # A row per part, as many as shuffle partitions: bounded by a setting.
    blocks = blocks.join(F.broadcast(index), "part").select("base", "first", "n_ids", "doc_ids", "doc_lengths", "steps", "bits")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return blocks.mapInArrow(run, schema)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the coded corpus to the shared folder and read it back.

    Defined cases: null and empty texts are the end id alone; a null doc_id
    sorts first; rows sharing a doc_id are adjacent, in order of their ids;
    an empty table gives no rows; further columns are ignored.
    """
    path = scratch_path(spark, "llm-huffman")
    write_corpus(spark, docs, tokenizer, path)
    return read_corpus(spark, path)
