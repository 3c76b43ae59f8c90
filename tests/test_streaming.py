import glob
import os
from datetime import date, datetime, timedelta

import pytest

from starlane.operators.incremental import read_fact
from starlane.operators.standardize import YELLOW, DateWindow
from starlane.streaming.trips_stream import enriched_stream, read_feed_stream, run_available_now

from tests.test_pipeline_ops import raw

T = datetime(2024, 10, 10, 12, 0)


def trip(p, **kw):
    return dict(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + timedelta(minutes=10), **kw)


@pytest.mark.parametrize("files", [1, 2, None])
def test_stream_is_complete_whatever_the_batches(spark, tmp_dir, files):
    src = f"{tmp_dir}/src"
    batches = [
        [trip(T), trip(T)],
        [trip(T + timedelta(hours=1)), trip(T + timedelta(hours=2))],
        # a duplicate of T and a row three days late
        [trip(T, payment_type=2), trip(T - timedelta(days=3)), trip(T + timedelta(hours=3))],
    ]
    seen: set[str] = set()
    for i, rows in enumerate(batches):
        raw(spark, rows).coalesce(1).write.parquet(src, mode="append")
        # The file source takes files in modification-time order: pin it.
        for f in set(glob.glob(f"{src}/*.parquet")) - seen:
            os.utime(f, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
            seen.add(f)
    window = DateWindow(date(2024, 10, 1), date(2024, 10, 31))
    for _ in range(2):  # started again, it finds nothing new
        stream = enriched_stream([(read_feed_stream(spark, src, max_files_per_trigger=files), YELLOW)], window)
        run_available_now(stream, f"{tmp_dir}/fact", f"{tmp_dir}/ckpt")
    got = sorted(r.pickup_datetime for r in read_fact(spark, f"{tmp_dir}/fact").collect())
    assert got == [T - timedelta(days=3), *[T + timedelta(hours=h) for h in range(4)]]
