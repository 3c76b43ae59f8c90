"""The stored fact as snapshots: commit, pruning by months and filters, ledger."""

import contextlib
import glob
import io
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starlane.operators import snapshots
from starlane.operators.facts import build_fact
from starlane.operators.incremental import high_water, insert_new, load_incremental, load_ledger, read_fact, write_fact
from starlane.operators.snapshots import PARTITION_COLUMN, ConcurrentLoadError, FactTable

from tests.test_incremental_files import trips

SEP, OCT, NOV = datetime(2024, 9, 3, 8), datetime(2024, 10, 3, 8), datetime(2024, 11, 3, 8)


def hours(start, n):
    return [start + timedelta(hours=i) for i in range(n)]


def pickups(spark, target, version=None):
    rows = FactTable(spark, target).read(version)
    return sorted((r.pickup_datetime, r.payment_type_id) for r in rows.collect())


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("step", ["filters", "snapshot", "pointer"])
def test_a_load_that_fails_before_the_pointer_moves_changes_nothing(spark, tmp_dir, monkeypatch, step):
    target = f"{tmp_dir}/fact"
    load_incremental(spark, target, trips(spark, [SEP, OCT], payment_type=2), "upsert")
    before = pickups(spark, target)

    def fails(*args, **kwargs):
        raise OSError("lost")

    real = snapshots.write_text
    if step == "filters":
        monkeypatch.setattr(FactTable, "_held", fails)
    else:
        name = "_current" if step == "pointer" else ".json"
        monkeypatch.setattr(snapshots, "write_text", lambda s, p, t: fails() if p.endswith(name) else real(s, p, t))
    for load in (lambda b: load_incremental(spark, target, b, "upsert"), lambda b: insert_new(spark, target, b)):
        with pytest.raises(OSError):
            load(trips(spark, [SEP, OCT, NOV], payment_type=1))
        assert pickups(spark, target) == before
    monkeypatch.undo()
    load_incremental(spark, target, trips(spark, [OCT, NOV], payment_type=1), "upsert")
    assert pickups(spark, target) == [(SEP, 2), (OCT, 1), (NOV, 1)]
    gone = FactTable(spark, target).expire()  # what the failed loads left, and the replaced month
    assert gone and pickups(spark, target) == [(SEP, 2), (OCT, 1), (NOV, 1)]
    live = {(p.load, p.month) for p in FactTable(spark, target).snapshot().pieces}
    assert len(glob.glob(f"{target}/_data/load=*/{PARTITION_COLUMN}=*")) == len(live)


def test_upsert_reads_only_pieces_that_may_hold_its_trips(spark, tmp_dir, monkeypatch):
    target = f"{tmp_dir}/fact"
    for start in (SEP, OCT, NOV):
        load_incremental(spark, target, trips(spark, hours(start, 40), payment_type=2), "append")
    load_incremental(spark, target, trips(spark, hours(NOV + timedelta(days=9), 40), payment_type=2), "append")
    read = []
    real = FactTable.rows_of

    def noted(self, pieces):
        read.append((list(pieces), real(self, pieces)))
        return read[-1][1]

    monkeypatch.setattr(FactTable, "rows_of", noted)
    load_incremental(spark, target, trips(spark, hours(NOV, 3), payment_type=1), "upsert")
    assert [[(p.month, p.rows) for p in some] for some, _ in read] == [[(202411, 40)]]  # not the other piece of that month
    plan = plan_of(read[0][1])
    assert f"{PARTITION_COLUMN}#" in plan and "202411" in plan.split("PartitionFilters")[1].splitlines()[0]
    assert all("202411" in f for f in read[0][1].inputFiles())
    monkeypatch.undo()
    assert read_fact(spark, target).count() == 160
    assert read_fact(spark, target).where("payment_type_id = 1").count() == 3
    assert sorted(p.rows for p in FactTable(spark, target).snapshot().pieces) == [3, 37, 40, 40, 40]


def test_insert_of_new_trips_reads_no_stored_rows(spark, tmp_dir, monkeypatch):
    target = f"{tmp_dir}/fact"
    insert_new(spark, target, trips(spark, hours(OCT, 60)))
    read = []
    real = FactTable.rows_of
    monkeypatch.setattr(FactTable, "rows_of", lambda self, pieces: (read.append(list(pieces)), real(self, pieces))[1])
    insert_new(spark, target, trips(spark, hours(OCT - timedelta(days=2), 20)))  # late, in the same month
    assert read == []
    insert_new(spark, target, trips(spark, hours(OCT, 60) + [NOV]))
    assert [sum(p.rows for p in some) for some in read] == [60]
    monkeypatch.undo()
    assert read_fact(spark, target).count() == 81
    ledger = [(r.version, r.mode, r.rows_in, r.rows_added, r.rows_total) for r in load_ledger(spark, target).orderBy("version").collect()]
    assert ledger == [(1, "insert", 60, 60, 60), (2, "insert", 20, 20, 80), (3, "insert", 61, 1, 81)]


def test_filters_never_miss_a_stored_trip(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    table = FactTable(spark, target)
    load_incremental(spark, target, trips(spark, hours(OCT, 500)), "full")
    pieces = table.snapshot().pieces
    ids = table.rows_of(pieces).select("trip_id", PARTITION_COLUMN)
    for i in range(0, 500, 100):
        one = ids.orderBy("trip_id").offset(i).limit(1)
        assert table.may_hold(one, pieces)
    other = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("trip_id"), F.lit(202410).alias(PARTITION_COLUMN))
    words = spark.read.parquet(f"{target}/_blooms/load={pieces[0].load}")
    word = snapshots._word(F.col("trip_id"), F.lit(pieces[0].words).cast("long"))
    met = other.select(word.alias("word"), snapshots._mask(F.col("trip_id")).alias("mask")).join(words, "word")
    assert met.where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).count() < 0.03 * 4000
    assert table.may_hold(other.where("false"), pieces) == []


def test_high_water_is_metadata(spark, tmp_dir):
    import shutil

    target = f"{tmp_dir}/fact"
    load_incremental(spark, target, trips(spark, [SEP, OCT]), "append")
    load_incremental(spark, target, trips(spark, [NOV]), "append")
    shutil.move(f"{target}/_data", f"{tmp_dir}/away")
    assert high_water(spark, target) == NOV


def test_rows_keep_the_time_of_their_load(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    first, second = datetime(2025, 1, 1, 10), datetime(2025, 1, 2, 11, 30)
    load_incremental(spark, target, trips(spark, hours(SEP, 5) + hours(OCT, 5)), "append", at=first)
    load_incremental(spark, target, trips(spark, hours(OCT, 2) + hours(NOV, 1)), "upsert", at=second)
    rows = load_ledger(spark, target).orderBy("version").collect()
    assert [(r.mode, r.loaded_at, r.rows_in, r.rows_added, r.rows_removed, r.rows_total, r.rows_live) for r in rows] == [
        ("full", first, 10, 10, 0, 10, 8),
        ("upsert", second, 3, 3, 2, 11, 3),
    ]
    assert pickups(spark, target, 1) != pickups(spark, target)  # an earlier snapshot stays readable
    assert len(pickups(spark, target, 1)) == 10


def test_small_pieces_of_a_month_are_merged(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(snapshots, "MAX_PIECES", 3)
    target = f"{tmp_dir}/fact"
    insert_new(spark, target, trips(spark, hours(OCT, 200)))
    for i in range(5):
        insert_new(spark, target, trips(spark, hours(OCT + timedelta(days=10 + i), 2)))
    pieces = FactTable(spark, target).snapshot().pieces
    assert len(pieces) <= 4 and max(p.rows for p in pieces) == 200  # the large one is left alone
    assert read_fact(spark, target).count() == 210 == read_fact(spark, target).select("trip_id").distinct().count()
    assert load_ledger(spark, target).count() == 6


def test_two_writers_do_not_overwrite_each_other(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    load_incremental(spark, target, trips(spark, [SEP]), "append")
    slow = FactTable(spark, target)
    base = slow.snapshot()
    load_incremental(spark, target, trips(spark, [OCT]), "append")
    with pytest.raises(ConcurrentLoadError):
        slow._commit(base, base.pieces, "append", datetime(2025, 1, 1), "x", 0, 0)
    assert [p for p, _ in pickups(spark, target)] == [SEP, OCT]


def test_a_plain_table_is_taken_over(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    write_fact(build_fact(trips(spark, [SEP, OCT], payment_type=2)), target)
    assert high_water(spark, target) == OCT
    load_incremental(spark, target, trips(spark, [OCT, NOV], payment_type=1), "upsert")
    assert pickups(spark, target) == [(SEP, 2), (OCT, 1), (NOV, 1)]
    load_incremental(spark, target, trips(spark, [NOV, NOV + timedelta(days=1)], payment_type=1), "append")
    assert len(pickups(spark, target)) == 4


def test_empty_batches(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    empty = trips(spark, [OCT]).where("false")
    for load in ("append", "upsert"):
        load_incremental(spark, target, empty, load)
    insert_new(spark, target, empty)
    assert read_fact(spark, target).count() == 0 and high_water(spark, target) == datetime(1900, 1, 1)
    insert_new(spark, target, trips(spark, [OCT]))
    insert_new(spark, target, empty)
    assert read_fact(spark, target).count() == 1


@pytest.mark.parametrize("load", ["insert", "upsert"])
def test_a_large_batch_asks_the_stored_ids_of_its_months_not_all_filter_words(spark, tmp_dir, monkeypatch, load):
    target = f"{tmp_dir}/fact"
    monkeypatch.setattr(snapshots, "SMALL_BATCH", 1)

    def asked(*args):
        raise AssertionError("filters asked")

    monkeypatch.setattr(FactTable, "may_hold", asked)
    put = {"insert": insert_new, "upsert": lambda *a: load_incremental(*a, "upsert")}[load]
    put(spark, target, trips(spark, hours(SEP, 30) + hours(OCT, 60), payment_type=2))
    put(spark, target, trips(spark, hours(OCT - timedelta(days=2), 20), payment_type=2))  # late, shares no trip
    put(spark, target, trips(spark, hours(OCT, 60) + [NOV], payment_type=1))
    table = FactTable(spark, target)
    rows = [(p.month, p.rows) for p in table.snapshot().pieces]
    assert sorted(rows) == [(202409, 30), (202410, 20), (202410, 60), (202411, 1)] or sum(n for _, n in rows) == 111
    paid = {r.payment_type_id: r["count"] for r in read_fact(spark, target).groupBy("payment_type_id").count().collect()}
    assert paid == ({2: 110, 1: 1} if load == "insert" else {2: 50, 1: 61})
    assert table.read().select("trip_id").distinct().count() == 111
    table.expire()
    assert not glob.glob(f"{target}/_met/*") and table.read().count() == 111


def test_what_a_large_batch_may_share_is_filtered_before_its_shuffle(spark, tmp_dir, monkeypatch):
    """Spark puts a Bloom filter of the batch's ids on the scan of the stored ones."""
    from pyspark.sql.readwriter import DataFrameWriter

    target = f"{tmp_dir}/fact"
    insert_new(spark, target, trips(spark, hours(OCT, 300)))
    monkeypatch.setattr(snapshots, "SMALL_BATCH", 1)
    plans, real = [], DataFrameWriter.parquet

    def noted(self, path, *a, **k):
        if "/_met/" in path:
            plans.append(plan_of(self._df))
        return real(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        insert_new(spark, target, trips(spark, hours(OCT + timedelta(hours=100), 300)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(plans) == 1 and "might_contain" in plans[0]
    assert read_fact(spark, target).count() == 400
