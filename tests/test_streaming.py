"""Streaming feature state: in-order ticks equal the batch features; a tick
older than the newest one seen is flagged late and does not enter the state."""

import datetime as dt
import uuid

from panelcast.session import scratch_path
from panelcast.streaming.features import stream_features
from panelcast.streaming.ingest import run_available

SCHEMA = "user_id bigint, ts timestamp_ntz, value double"


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_late_tick_is_flagged_and_kept_out_of_state(spark):
    base = scratch_path(spark, f"test-stream-{uuid.uuid4().hex}")
    t = lambda d: dt.datetime(2024, 1, d)
    _write(spark, f"{base}/src", [(1, t(1), 10.0), (1, t(2), 20.0), (1, t(4), 40.0)])
    _write(spark, f"{base}/src", [(1, t(3), 30.0), (1, t(5), 50.0)])     # day 3 arrives late
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    run_available(stream_features(src, "user_id", "ts", "value"), f"{base}/out", f"{base}/ckpt",
                  state_partitions=2)
    rows = {r.ts.day: r for r in spark.read.parquet(f"{base}/out").collect()}
    assert [rows[d].late for d in (1, 2, 4, 3, 5)] == [False, False, False, True, False]
    # the late tick is scored against the stored history (10, 20, 40)
    assert rows[3].value_lag1 == 40.0 and rows[3].value_lag3 == 10.0
    assert rows[3].value_roll7_mean == (10 + 20 + 40 + 30) / 4
    # ... and does not enter it: day 5 follows 40 directly
    assert rows[5].value_lag1 == 40.0 and rows[5].value_lag3 == 10.0
    assert rows[5].value_pct_change == 50.0 / 40.0 - 1
    assert rows[2].value_lag1 == 10.0 and rows[2].value_roll7_mean is None   # fewer than 3 values


def test_idle_state_expires(spark):
    base = scratch_path(spark, f"test-stream-{uuid.uuid4().hex}")
    t = lambda d: dt.datetime(2024, 1, d)
    _write(spark, f"{base}/src", [(1, t(1), 10.0), (1, t(2), 20.0), (2, t(2), 5.0)])
    _write(spark, f"{base}/src", [(2, t(10), 6.0)])     # moves the watermark past user 1's timeout
    _write(spark, f"{base}/src", [(3, t(11), 7.0)])     # a batch without user 1: its state expires
    _write(spark, f"{base}/src", [(1, t(12), 30.0)])    # user 1 returns without history
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    feats = stream_features(src, "user_id", "ts", "value", idle_timeout="2 days", watermark="0 seconds")
    run_available(feats, f"{base}/out", f"{base}/ckpt", state_partitions=2)
    rows = {(r.user_id, r.ts.day): r for r in spark.read.parquet(f"{base}/out").collect()}
    assert rows[(1, 2)].value_lag1 == 10.0
    assert rows[(2, 10)].value_lag1 == 5.0            # user 2 was active: history kept
    assert rows[(1, 12)].value_lag1 is None           # user 1's idle state was dropped


def test_entities_of_one_bucket_keep_their_own_state(spark):
    """Null entities, values and zeros, all entities in one bucket."""
    base = scratch_path(spark, f"test-stream-{uuid.uuid4().hex}")
    t = lambda d: dt.datetime(2024, 1, d)
    ticks = [(u, t(d), None if (d + (u or 0)) % 5 == 0 else float((d * 7 + (u or 0)) % 4)) for d in range(1, 29) for u in (0, 1, None, 2)]
    for c in range(4):
        _write(spark, f"{base}/src", [r for r in ticks if (r[1].day - 1) // 7 == c])
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    calls = stream_features(src, "user_id", "ts", "value", buckets=1)
    run_available(calls, f"{base}/out", f"{base}/ckpt", state_partitions=2)
    got = {(r.user_id, r.ts.day): r for r in spark.read.parquet(f"{base}/out").collect()}
    assert len(got) == len(ticks)
    for u in (0, 1, None, 2):
        x = [v for e, _, v in ticks if e == u]
        for i, v in enumerate(x):
            r, near = got[(u, i + 1)], [w for w in x[max(0, i - 6):i + 1] if w is not None]
            assert r.value == v and not r.late
            assert (r.value_lag1, r.value_lag3) == (x[i - 1] if i else None, x[i - 3] if i > 2 else None)
            assert r.value_roll7_mean == (sum(near) / len(near) if len(near) >= 3 else None)
            assert r.value_pct_change == (v / x[i - 1] - 1 if v is not None and i and x[i - 1] else None)
