"""The stored trip fact as snapshots: versioned folders and one pointer file.

A load writes its rows under ``_data/load=<id>/pickup_month=<m>``, a snapshot
file names the pieces (load, month) that are the table from then on, and moving
the pointer file ``_current`` makes that the table: in one step, whatever the
number of months. Until then readers see the table before; what a failed load
left is referenced by no snapshot and goes with ``expire``. Pieces are never
changed, so a reader keeps its snapshot while loads go on. One writer at a time:
a load that finds the pointer moved since it began raises.

For each piece the snapshot holds its rows and latest pickup, which makes the
high-water mark a matter of metadata, and beside the files lies a Bloom filter
of its trip ids (a table of 64-bit words). A small batch is set against the
filters of the months it touches, and reads only the pieces that may hold its
trips. A large one would ask all words of all filters: it reads the stored ids of
its months instead, behind one Bloom filter of its own ids, so that only ids it
may share are shuffled. Either way what a load shuffles and writes follows the
batch, not the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.operators.facts import FACT_COLUMNS, FACT_TYPES, PARTITION_COLUMN, month_of
from starlane.session import settings

DEFAULT_HIGH_WATER = datetime(1900, 1, 1)
# The load id of months that a plain write left in the table's own folder.
PLAIN = "plain"
# Bits of a filter word that a trip id sets, and words a piece has per id.
BLOOM_BITS = 6
BLOOM_IDS_PER_WORD = 4
# A month of more pieces is merged, beginning with the small ones.
MAX_PIECES = 8
_MERGE_RATIO = 4
# Batches of up to so many rows ask the pieces' filters: few enough to be
# broadcast with a probe for each piece of a month.
SMALL_BATCH = 10_000
# Spark's own runtime filter on the stored ids, whatever the size of the two sides.
_FILTERED = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(2**62),
}

FACT_SCHEMA = ", ".join(f"{c} {FACT_TYPES[c]}" for c in FACT_COLUMNS)
LOAD_SCHEMA = "load string, mode string, loaded_at timestamp, rows_in long, rows_added long, rows_removed long, rows_total long"


class ConcurrentLoadError(RuntimeError):
    """Another load moved the pointer in the meantime."""


@dataclass(frozen=True)
class Piece:
    """The rows of one load in one pickup month."""

    load: str
    month: int
    rows: int
    last: datetime | None
    words: int  # of its Bloom filter; 0: none, it may hold any trip of its month


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    pieces: tuple[Piece, ...] = ()
    load: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.pieces)

    def to_json(self) -> str:
        pieces = [{"load": p.load, "month": p.month, "rows": p.rows, "last": p.last and p.last.isoformat(), "words": p.words} for p in self.pieces]
        return json.dumps({"version": self.version, "load": self.load, "pieces": pieces})

    @staticmethod
    def from_json(text: str) -> Snapshot:
        found = json.loads(text)
        pieces = tuple(Piece(p["load"], p["month"], p["rows"], p["last"] and datetime.fromisoformat(p["last"]), p["words"]) for p in found["pieces"])
        return Snapshot(found["version"], pieces, found["load"])


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text by Spark's own file systems; None where there is no file."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: written beside it, then renamed over it.

    A store without such a rename (object stores) replaces a file whole when
    its stream is closed.
    """
    fs, at = _file_system(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    except Exception:  # no such interface for this scheme
        context = None
    target = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}") if context else at
    out = fs.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if context:
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fs.makeQualified(target), fs.makeQualified(at), options)


def months_of(fact: DataFrame) -> DataFrame:
    return fact.withColumn(PARTITION_COLUMN, month_of(F.col("pickup_date_key")))


def check_types(fact: DataFrame) -> None:
    """Raise unless the fact has its declared column types: a stored fact
    whose months differ in type could not be read again."""
    wrong = {n: t for n, t in fact.dtypes if FACT_TYPES.get(n, t) != t}
    if wrong:
        raise TypeError(f"fact columns of another type than declared: {wrong}")


def write_by_month(fact: DataFrame, path: str, mode: str, balanced: bool = False, overwrite: str = "static") -> None:
    """Rows are rebalanced on the month first, so each month is written by a few
    tasks (few files); AQE splits a hot month and merges small ones. ``balanced``:
    they are, with their month (``build_fact_by_month``)."""
    check_types(fact)
    rows = fact if balanced else months_of(fact).hint("rebalance", PARTITION_COLUMN)
    w = rows.write.mode(mode).option("partitionOverwriteMode", overwrite).option("compression", "zstd")
    w.partitionBy(PARTITION_COLUMN).parquet(path)


def _word(trip_id: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(trip_id), words)


def _mask(trip_id: Column) -> Column:
    """The bits of its word that an id sets."""
    h = F.xxhash64(F.lit("bits"), trip_id)
    one = F.lit(1).cast("long")
    mask = F.lit(0).cast("long")
    for i in range(BLOOM_BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, place))
    return mask


class FactTable:
    """A trip fact stored under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # -- snapshots ---------------------------------------------------------

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The current (or an earlier) snapshot; None where there is no table."""
        if version is None:
            pointer = read_text(self.spark, f"{self.root}/_current")
            if pointer is None:
                return self._plain()
            version = int(pointer)
        text = read_text(self.spark, self._snapshot_file(version))
        if text is None:
            raise FileNotFoundError(f"snapshot {version} of {self.root}")
        return Snapshot.from_json(text)

    def _snapshot_file(self, version: int) -> str:
        return f"{self.root}/_snapshots/v{version:010d}.json"

    def _plain(self) -> Snapshot | None:
        """A table that ``write_fact`` left, as version 0; None if there is none."""
        try:
            rows = self.spark.read.parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        found = rows.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("n"), F.max("pickup_datetime").alias("last")).collect()
        return Snapshot(0, tuple(Piece(PLAIN, r[PARTITION_COLUMN], r.n, r.last, 0) for r in found))

    def _commit(self, base: Snapshot, pieces: Sequence[Piece], mode: str, at: datetime, load: str, rows_in: int, rows_added: int) -> Snapshot:
        """Write the next snapshot, then move the pointer to it."""
        rows = sum(p.rows for p in pieces)
        entry = {
            "load": load,
            "mode": mode,
            "loaded_at": at.isoformat(),
            "rows_in": rows_in,
            "rows_added": rows_added,
            "rows_removed": base.rows + rows_added - rows,
            "rows_total": rows,
        }
        following = Snapshot(base.version + 1, tuple(sorted(pieces, key=lambda p: (p.month, p.load))), entry)
        pointer = read_text(self.spark, f"{self.root}/_current")
        if (int(pointer) if pointer else 0) != base.version:
            raise ConcurrentLoadError(f"{self.root} is at version {pointer}, the load began at {base.version}")
        write_text(self.spark, self._snapshot_file(following.version), following.to_json())
        write_text(self.spark, f"{self.root}/_current", str(following.version))
        return following

    # -- reading -----------------------------------------------------------

    def _piece_path(self, p: Piece, below: str = "_data") -> str:
        if p.load == PLAIN:
            return f"{self.root}/{PARTITION_COLUMN}={p.month}"
        return f"{self.root}/{below}/load={p.load}/{PARTITION_COLUMN}={p.month}"

    def rows_of(self, pieces: Sequence[Piece]) -> DataFrame:
        """Fact columns, load and pickup_month of some pieces, with their months
        as literals on the partition column."""
        kinds = [[p for p in pieces if (p.load == PLAIN) == plain] for plain in (False, True)]
        frames = []
        for some, base, extra in zip(kinds, (f"{self.root}/_data", self.root), ("load string, ", "")):
            if some:
                schema = f"{FACT_SCHEMA}, {extra}{PARTITION_COLUMN} int"
                rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[self._piece_path(p) for p in some])
                rows = rows.where(F.col(PARTITION_COLUMN).isin(sorted({p.month for p in some})))
                frames.append(rows.select(*FACT_COLUMNS, (F.col("load") if extra else F.lit(PLAIN)).alias("load"), PARTITION_COLUMN))
        if not frames:
            return self.spark.createDataFrame([], f"{FACT_SCHEMA}, load string, {PARTITION_COLUMN} int")
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def read(self, version: int | None = None) -> DataFrame:
        """The fact as of now, or of an earlier version that ``expire`` has left."""
        found = self.snapshot(version)
        if found is None:
            raise FileNotFoundError(f"no fact at {self.root}")
        return self.rows_of(found.pieces).select(*FACT_COLUMNS)

    def high_water(self) -> datetime:
        """max(pickup) from the snapshot alone."""
        found = self.snapshot()
        return max((p.last for p in found.pieces if p.last is not None), default=DEFAULT_HIGH_WATER) if found else DEFAULT_HIGH_WATER

    def loads(self) -> DataFrame:
        """The load ledger: version and LOAD_SCHEMA, a row a load."""
        found = self.snapshot()
        current = found.version if found else 0
        if not current:
            return self.spark.createDataFrame([], f"version long, {LOAD_SCHEMA}")
        rows = self.spark.read.schema(f"version long, load struct<{LOAD_SCHEMA.replace(' ', ':').replace(',:', ',')}>").json(f"{self.root}/_snapshots")
        return rows.where(F.col("version") <= current).select("version", "load.*")

    # -- which pieces may hold a batch's trips -------------------------------

    def _held(self, load: str) -> tuple[Piece, ...]:
        """The pieces a load has written, with their filters."""
        path = f"{self.root}/_data/load={load}"
        try:
            rows = self.spark.read.schema(f"{FACT_SCHEMA}, {PARTITION_COLUMN} int").parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return ()
            raise
        found = rows.groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("n"), F.max("pickup_datetime").alias("last")).collect()
        pieces = tuple(Piece(load, r[PARTITION_COLUMN], r.n, r.last, r.n // BLOOM_IDS_PER_WORD + 1) for r in found)
        if pieces:
            words = F.element_at(F.create_map(*[F.lit(x).cast("long") for p in pieces for x in (p.month, p.words)]), F.col(PARTITION_COLUMN).cast("long"))
            bits = rows.select(PARTITION_COLUMN, _word(F.col("trip_id"), words).alias("word"), _mask(F.col("trip_id")).alias("mask"))
            bits = bits.groupBy(PARTITION_COLUMN, "word").agg(F.bit_or("mask").alias("bits"))
            bits.hint("rebalance", PARTITION_COLUMN).write.partitionBy(PARTITION_COLUMN).parquet(f"{self.root}/_blooms/load={load}")
        return pieces

    def may_hold(self, ids: DataFrame, pieces: Sequence[Piece]) -> list[Piece]:
        """The pieces whose filter has some id of ``ids`` (trip_id, pickup_month)."""
        pieces = self._months(ids, pieces)
        sure, asked = [p for p in pieces if not p.words], [p for p in pieces if p.words]
        if not asked:
            return sure
        by_month: dict[int, list[Piece]] = {}
        for p in asked:
            by_month.setdefault(p.month, []).append(p)
        entry = lambda p: F.struct(F.lit(p.load).alias("load"), F.lit(p.words).cast("long").alias("words"))
        offered = F.create_map(*[x for m, some in by_month.items() for x in (F.lit(m), F.array(*map(entry, some)))])
        probes = ids.where(F.col(PARTITION_COLUMN).isin(list(by_month))).select("trip_id", PARTITION_COLUMN, F.explode(F.element_at(offered, F.col(PARTITION_COLUMN))).alias("p"))
        probes = probes.select("p.load", PARTITION_COLUMN, _word(F.col("trip_id"), F.col("p.words")).alias("word"), _mask(F.col("trip_id")).alias("mask"))
        paths = [self._piece_path(p, "_blooms") for p in asked]
        schema = f"word long, bits long, load string, {PARTITION_COLUMN} int"
        filters = self.spark.read.schema(schema).option("basePath", f"{self.root}/_blooms").parquet(*paths)
        met = probes.join(filters, ["load", PARTITION_COLUMN, "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        hit = {tuple(r) for r in met.select("load", PARTITION_COLUMN).distinct().collect()}
        return [*sure, *[p for p in asked if (p.load, p.month) in hit]]

    def _months(self, ids: DataFrame, pieces: Sequence[Piece]) -> list[Piece]:
        months = {r[0] for r in ids.select(PARTITION_COLUMN).distinct().collect()}
        return [p for p in pieces if p.month in months]

    def _met(self, ids: DataFrame, n: int, pieces: Sequence[Piece], load: str) -> tuple[list[Piece], DataFrame | None]:
        """The pieces that hold some of the ``n`` ``ids`` (trip_id, pickup_month), and
        their rows with such an id (load, trip_id, pickup_month), written beside the
        table; for a small batch the pieces that may hold some, and None."""
        if n <= SMALL_BATCH:
            return self.may_hold(ids, pieces), None
        pieces = self._months(ids, pieces)
        if not pieces:
            return [], None
        stored = self.rows_of(pieces).select("load", "trip_id", PARTITION_COLUMN)
        # Spark filters by the ids of a side that is filtered itself.
        asked = ids.where(F.col("trip_id") >= "")
        bits = 1 << max(20, min(16 * n, 2**26).bit_length() - 1)
        sizes = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": str(v) for k, v in (("numBits", bits), ("expectedNumItems", n), ("maxNumItems", max(n, 4_000_000)))}
        path = f"{self.root}/_met/load={load}"
        with settings(self.spark, {**_FILTERED, **sizes}):
            met = stored.join(asked.select("trip_id"), "trip_id", "left_semi").join(ids, ["trip_id", PARTITION_COLUMN], "left_semi")
            met.select("load", "trip_id", PARTITION_COLUMN).write.parquet(path)
        met = self.spark.read.schema(f"load string, trip_id string, {PARTITION_COLUMN} int").parquet(path)
        hit = {tuple(r) for r in met.select("load", PARTITION_COLUMN).distinct().collect()}
        return [p for p in pieces if (p.load, p.month) in hit], met

    # -- loading (``balanced`` as in ``write_by_month``) ---------------------

    def _begin(self) -> tuple[Snapshot, str]:
        base = self.snapshot() or Snapshot()
        return base, f"b{base.version + 1:06d}-{uuid.uuid4().hex[:8]}"

    def _data(self, load: str) -> str:
        return f"{self.root}/_data/load={load}"

    def replace(self, fact: DataFrame, at: datetime, balanced: bool = False) -> Snapshot:
        """The table is ``fact`` alone."""
        base, load = self._begin()
        write_by_month(fact, self._data(load), "overwrite", balanced)
        pieces = self._held(load)
        n = sum(p.rows for p in pieces)
        return self._commit(base, pieces, "full", at, load, n, n)

    def append(self, fact: DataFrame, at: datetime, balanced: bool = False) -> Snapshot:
        """All rows of ``fact`` beside the stored ones."""
        base, load = self._begin()
        write_by_month(fact, self._data(load), "overwrite", balanced)
        pieces = self._held(load)
        n = sum(p.rows for p in pieces)
        return self._merged(self._commit(base, (*base.pieces, *pieces), "append", at, load, n, n), at)

    def upsert(self, fact: DataFrame, at: datetime, balanced: bool = False) -> Snapshot:
        """Delete + insert on trip_id: pieces that may hold a trip of ``fact``
        are written anew without them, beside its rows; all others stay."""
        base, load = self._begin()
        write_by_month(fact, self._data(load), "overwrite", balanced)
        batch = self.spark.read.schema(f"{FACT_SCHEMA}, {PARTITION_COLUMN} int").parquet(self._data(load))
        ids = batch.select("trip_id", PARTITION_COLUMN)
        rows_in = ids.count()
        old, _ = self._met(ids, rows_in, base.pieces, load)
        if old:
            kept = self.rows_of(old).join(ids, [PARTITION_COLUMN, "trip_id"], "left_anti")
            # Beside the batch, whose files the join reads: into a folder of its own first.
            held = f"{load}k"
            write_by_month(kept.select(*FACT_COLUMNS), self._data(held), "overwrite")
            pieces = (*self._held(load), *self._held(held))
        else:
            pieces = self._held(load)
        stay = [p for p in base.pieces if p not in old]
        return self._merged(self._commit(base, (*stay, *pieces), "upsert", at, load, rows_in, rows_in), at)

    def insert(self, fact: DataFrame, at: datetime, balanced: bool = False) -> Snapshot:
        """The rows of ``fact`` whose trip_id is not stored yet."""
        base, load = self._begin()
        write_by_month(fact, self._data(load), "overwrite", balanced)
        batch = self.spark.read.schema(f"{FACT_SCHEMA}, {PARTITION_COLUMN} int").parquet(self._data(load))
        rows_in = batch.count()
        old, met = self._met(batch.select("trip_id", PARTITION_COLUMN), rows_in, base.pieces, load)
        if old:
            stored = (self.rows_of(old) if met is None else met).select(PARTITION_COLUMN, "trip_id")
            load = f"{load}n"
            write_by_month(batch.join(stored, [PARTITION_COLUMN, "trip_id"], "left_anti").select(*FACT_COLUMNS), self._data(load), "overwrite")
        pieces = self._held(load)
        return self._merged(self._commit(base, (*base.pieces, *pieces), "insert", at, load, rows_in, sum(p.rows for p in pieces)), at)

    def _merged(self, base: Snapshot, at: datetime) -> Snapshot:
        """Months of many pieces with their small ones merged: each as long as
        the next larger one is no more than a few times as large, so a row is
        rewritten a logarithmic number of times."""
        by_month: dict[int, list[Piece]] = {}
        for p in sorted(base.pieces, key=lambda p: p.rows):
            by_month.setdefault(p.month, []).append(p)
        some: list[Piece] = []
        for pieces in by_month.values():
            if len(pieces) > MAX_PIECES:
                group, total = pieces[:2], sum(p.rows for p in pieces[:2])
                for p in pieces[2:]:
                    if p.rows > _MERGE_RATIO * total:
                        break
                    group.append(p)
                    total += p.rows
                some += group
        if not some:
            return base
        load = f"b{base.version + 1:06d}-{uuid.uuid4().hex[:8]}m"
        write_by_month(self.rows_of(some).select(*FACT_COLUMNS), self._data(load), "overwrite")
        return self._commit(base, (*[p for p in base.pieces if p not in some], *self._held(load)), "merge", at, load, 0, 0)

    def expire(self) -> list[str]:
        """Delete the piece folders that the current snapshot does not name, and return them."""
        found = self.snapshot()
        live = {(p.load, p.month) for p in found.pieces} if found else set()
        gone = []
        for below in ("_data", "_blooms"):
            fs, top = _file_system(self.spark, f"{self.root}/{below}")
            for folder in fs.listStatus(top) if found and found.version and fs.exists(top) else []:
                load = folder.getPath().getName().removeprefix("load=")
                for part in fs.listStatus(folder.getPath()):
                    name = part.getPath().getName()
                    if name.startswith(f"{PARTITION_COLUMN}=") and (load, int(name.split("=")[1])) not in live:
                        fs.delete(part.getPath(), True)
                        gone.append(part.getPath().toString())
        fs, met = _file_system(self.spark, f"{self.root}/_met")  # what loads noted for themselves
        if fs.exists(met):
            fs.delete(met, True)
        return gone


def now() -> datetime:
    return datetime.now(timezone.utc)


def stamped(batch: DataFrame, at: datetime) -> DataFrame:
    """The batch with its load time as a literal, kept by every later load."""
    return batch.withColumn("_loaded_at", F.lit(at).cast(T.TimestampType()))
