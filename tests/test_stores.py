"""Versioned stores, keyed tables with compaction, resumable batches and
bounded histories: failures, reruns and replays."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from panelcast.config import ForecastConfig, ModelConfig
from panelcast.models import saved as SV
from panelcast.session import scratch_path
from panelcast.sources.merge import BatchedUpsert, MergedTable
from panelcast.sources.versions import VersionedStore, append_epochs, folders
from panelcast.streaming.ingest import history_sink, run_available


def _path(spark, tag):
    return scratch_path(spark, f"test-{tag}-{uuid.uuid4().hex}")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _table(spark, rows):
    return spark.createDataFrame(rows, "day string, k long, v double")


def test_failed_commit_leaves_the_old_version(spark, monkeypatch):
    root = _path(spark, "store")
    store = VersionedStore(spark, root)
    assert store.versions() == [] and store.parts() == []
    with pytest.raises(ValueError):
        store.read()
    one = _table(spark, [("a", 1, 1.0), ("b", 2, 2.0)])
    assert store.commit({"table": one}, run="r1") == 0
    broken = VersionedStore(spark, root)

    def fail(*_):
        raise RuntimeError("the writer is lost before the manifest")
    monkeypatch.setattr(broken, "_publish", fail)
    with pytest.raises(RuntimeError):
        broken.commit({"table": one.withColumn("v", F.col("v") * 10)}, run="r2")
    back = VersionedStore(spark, root)
    assert back.versions() == [0] and _rows(back.read()) == _rows(one)
    # A manifest whose job did not end is no version, and its number is not used again.
    spark.createDataFrame([("x",)], "name string").write.json(f"{root}/commits/v={1:020d}")
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/commits/v={1:020d}/_SUCCESS")
    fs.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs, False)
    assert back.versions() == [0] and _rows(back.read()) == _rows(one)
    two = _table(spark, [("c", 3, 3.0)])
    assert back.commit({"table": two}, run="r3") == 2
    assert _rows(back.read()) == _rows(two) and _rows(back.read(version=0)) == _rows(one)
    assert len(folders(spark, f"{root}/data")) == 3        # the failed commit's data is still there
    back.vacuum(keep=1)
    assert back.versions() == [2] and len(folders(spark, f"{root}/data")) == 1 and _rows(back.read()) == _rows(two)


def test_parts_and_reruns(spark):
    store = VersionedStore(spark, _path(spark, "parts"))
    store.commit({"table": _table(spark, [("d1", 1, 1.0), ("d2", 2, 2.0), ("x y/z=1", 3, 3.0)])}, run="a", part_by="day")
    store.commit({"table": _table(spark, [("d2", 5, 5.0), ("d3", 6, 6.0)])}, run="b", part_by="day")
    assert store.parts() == ["d1", "d2", "d3", "x y/z=1"]
    assert _rows(store.read()) == [("d1", 1, 1.0), ("d2", 5, 5.0), ("d3", 6, 6.0), ("x y/z=1", 3, 3.0)]
    assert _rows(store.read(parts=["d2", "none"])) == [("d2", 5, 5.0)] and _rows(store.read(parts=[])) == []
    # The same run again, with other parts: what it wrote before goes.
    store.commit({"table": _table(spark, [("d4", 7, 7.0)])}, run="b", part_by="day")
    assert store.parts() == ["d1", "d4", "x y/z=1"]
    store.commit({"table": _table(spark, []).limit(0)}, run="b", part_by="day", parts=["d1", "x y/z=1"])
    assert store.parts() == [] and store.read().columns == ["day", "k", "v"] and store.read().count() == 0
    plan = store.read(version=0, parts=["d1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan


def test_train_save_read_back(spark):
    rng = random.Random(2)
    rows = [(e, i, float(i), rng.random(), 3.0 * i + rng.random()) for e in ("a", "b") for i in range(60)]
    d = spark.createDataFrame(rows, "e string, n int, x double, z double, y double").select(
        "e", F.date_add(F.lit("2024-01-01"), F.col("n")).alias("date"), "x", "z", "y")
    store = VersionedStore(spark, _path(spark, "models"))
    for _ in range(2):
        SV.train_and_save(store, d, ["x", "z"], "y", ("linear", "ridge", "lasso_pooled"), ModelConfig(), ("e",), run="r")
    back = VersionedStore(spark, store.root)
    assert back.info("best")["features"] == ["x", "z"] and back.info("best")["n_train"] == 96
    assert back.read("comparison").count() == 6 and back.read("coefficients").count() == 4
    wide = back.read("predictions")
    assert wide.columns == ["e", "date", "actual", "linear", "ridge", "lasso_pooled"] and wide.count() == 24
    # Saved scores: the pipeline gives what the table holds, the best linear model one of its columns.
    again = back.load_pipeline("pipeline_lasso_pooled").transform(d).select("e", "date", F.col("prediction").alias("p"))
    assert wide.join(again, ["e", "date"]).where(F.abs(F.col("p") - F.col("lasso_pooled")) > 1e-9).count() == 0
    cv = back.read("comparison").where("model = 'linear'").select("cv_mae").collect()
    assert all(0 < r.cv_mae < 1 for r in cv)
    old = {r.e: r.best_model for r in back.read("best").collect()}
    if "lasso_pooled" not in old.values():
        assert SV.score_saved(back, d).where("prediction IS NULL").count() == 0
    many, one = SV.forecast_saved(back, d, "x", ForecastConfig(entity=("e",), horizon=3))
    assert many.columns[:3] == ["e", "step", "date"] and one.count() <= 2


def test_history_is_bounded_where_it_is_stored(spark):
    path = _path(spark, "history")
    d = spark.range(150).select(F.col("id").cast("int").alias("epoch"), (F.col("id") * 2).alias("v"))
    for a, b in ((0, 60), (60, 110), (110, 150), (60, 110), (0, 5)):          # the last two are replays
        append_epochs(d.where((F.col("epoch") >= a) & (F.col("epoch") < b)), path, keep=100)
    assert len(folders(spark, path)) == 100
    assert _rows(spark.read.parquet(path).select("epoch", "v")) == sorted([(i, 2 * i) for i in range(50, 150)], key=repr)


def test_stream_history_is_bounded(spark):
    base = _path(spark, "t5")
    for i in range(7):
        spark.range(i + 1).select(F.col("id").cast("double").alias("value"), F.lit(f"2024-01-0{i + 1}").cast("timestamp_ntz").alias("ts")
                                  ).coalesce(1).write.mode("append").parquet(f"{base}/src")
    src = spark.readStream.schema("value double, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    run_available(src, checkpoint=f"{base}/c", foreach_batch=history_sink(f"{base}/h", "value", keep=3))
    assert sorted(r.batch_id for r in spark.read.parquet(f"{base}/h").collect()) == [4, 5, 6]


def test_merged_table_equals_a_dict(spark):
    rng = random.Random(5)
    schema = "k long, t long, v string"
    make = lambda rows: spark.createDataFrame(rows, schema)
    table = MergedTable(spark, _path(spark, "merged"), make([]).schema, ["k"], ["t"], buckets=4)
    assert table.read().count() == 0 and table.compact() == []
    want, batches = {}, []
    for epoch in range(9):
        keys = range(40) if epoch < 3 else [1, 2] if epoch < 6 else range(0, 90, 7)
        rows = [(k, t, f"{epoch}-{k}-{t}") for k in keys for t in rng.sample(range(9), 2)]
        if epoch == 4:
            rows.append((None, 1, "null key"))
        batches.append(rows)
        table.write(make(rows), epoch)
        for k, t, v in sorted(rows, key=lambda r: r[1]):
            want[k] = (k, t, v)
        if epoch in (2, 5):
            before = {r["part"]: r["c"] for r in table.base.manifest()}
            touched = table.compact()
            after = {r["part"]: r["c"] for r in table.base.manifest()}
            assert {p for p in before if before[p] == after[p]} == set(before) - set(touched)
            assert table.pending() == [] and (epoch == 2 or 0 < len(touched) < 4)
        if epoch == 7:
            table.write(make(batches[1]), 1)                     # replays: compacted, and pending
            table.write(make(batches[7]), 7)
        assert _rows(table.read()) == sorted(want.values(), key=repr)
    again = MergedTable(spark, table.path, table.schema, ["k"], ["t"], buckets=4)
    again.compact()
    assert _rows(again.read()) == sorted(want.values(), key=repr) and folders(spark, f"{table.path}/delta") == []


@pytest.mark.parametrize("broken_after", [0, 1, 3])
def test_upsert_resumes_after_any_batch(spark, broken_after):
    schema = "k long, v string"
    path = _path(spark, "batches")
    make = lambda: MergedTable(spark, f"{path}/table", spark.createDataFrame([], schema).schema, ["k"], buckets=3)
    target = make()
    target.write(spark.createDataFrame([(i, "old") for i in range(50)], schema), 0)
    new = spark.createDataFrame([(i, "new") for i in range(20, 83)], schema)
    first = BatchedUpsert(target, path, size=5, group=2)
    first.plan(new, ["k"])
    assert first.send(groups=broken_after) == broken_after
    first.target.write(spark.read.parquet(f"{path}/queue/epoch={first.groups()[broken_after]}").drop("batch_id"),
                       first.groups()[broken_after])             # written, not in the ledger
    assert first.ledger().where("state = 'done'").count() == 2 * broken_after
    if broken_after == 3:
        target.compact()
    again = BatchedUpsert(make(), path, size=5, group=2)
    again.plan(new, ["k"])
    assert again.send() == 7 - broken_after and again.send() == 0
    assert _rows(make().read()) == sorted([(i, "old") for i in range(20)] + [(i, "new") for i in range(20, 83)], key=repr)
    assert _rows(again.ledger()) == sorted([(b, 5 if b < 12 else 3, "done") for b in range(13)], key=repr)


def test_groups_of_a_batched_upsert_are_bounded(spark):
    path, schema = _path(spark, "batched"), "k long, v string"
    target = MergedTable(spark, f"{path}/table", spark.createDataFrame([], schema).schema, ["k"], buckets=2)
    sender = BatchedUpsert(target, path, size=5, group=2, max_groups=3)
    sender.plan(spark.createDataFrame([(i, "new") for i in range(133)], schema), ["k"])
    assert len(sender.groups()) == 3                             # of 27 batches, not 14 groups of 2
    assert sender.send(groups=1) == 1 and sender.ledger().where("state = 'done'").count() == 9
    assert sender.send() == 2 and _rows(target.read()) == sorted([(i, "new") for i in range(133)], key=repr)
    assert _rows(sender.ledger()) == sorted([(b, 5 if b < 26 else 3, "done") for b in range(27)], key=repr)
    empty = BatchedUpsert(target, f"{path}/none", size=5, group=2)
    empty.plan(spark.createDataFrame([], schema), ["k"])
    assert empty.send() == 0
