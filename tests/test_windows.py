"""Window operators, fills, dedupe: fixture rows and properties."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelcast.config import FeatureConfig
from panelcast.operators.align import asof_join, calendar, fill, series_window
from panelcast.operators.dedupe import dedupe, last_non_null_per_group
from panelcast.operators.features import add_features, rolling_mean_col
from panelcast.operators.split import chronological_split, contiguous_folds

D0 = dt.date(2024, 1, 1)


def _series(spark, values, entity="a"):
    rows = [(entity, D0 + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "e string, date date, gold double")


def test_rolling_support(spark):
    df = _series(spark, [float(i) for i in range(1, 9)])
    out = df.select("date", rolling_mean_col("gold", series_window(["e"]), 7, 3).alias("r")).orderBy("date").collect()
    got = [r.r for r in out]
    assert got[0] is None and got[1] is None
    assert got[2] == 2.0
    assert got[7] == np.mean(range(2, 9))


def test_fill_modes(spark):
    df = _series(spark, [None, None, 3.0, None, 5.0])
    ff = [r.gold for r in fill(df, ["gold"], ["e"], backward=False).orderBy("date").collect()]
    fb = [r.gold for r in fill(df, ["gold"], ["e"], backward=True).orderBy("date").collect()]
    fz = [r.gold for r in fill(df, ["gold"], ["e"], backward=False, zero=True).orderBy("date").collect()]
    assert ff == [None, None, 3.0, 3.0, 5.0]
    assert fb == [3.0, 3.0, 3.0, 3.0, 5.0]
    assert fz == [0.0, 0.0, 3.0, 3.0, 5.0]


def test_pct_change_zero_and_lag_lead_identity(spark):
    df = _series(spark, [0.0, 2.0, 4.0, 4.0])
    f = add_features(df, FeatureConfig(entity=("e",), variables=("gold",)), ["gold"]).orderBy("date").collect()
    assert f[1].gold_pct_change is None          # previous value 0 -> NULL (reference gives inf)
    assert f[2].gold_pct_change == 1.0
    # lag1 of the next row is the current value (lag1 . lead1 = id)
    for a, b in zip(f, f[1:]):
        assert b.gold_lag1 == a.gold and a.gold_next == b.gold


def test_features_invariant_under_repartition(spark):
    rng = random.Random(7)
    rows = [(e, D0 + dt.timedelta(days=i), rng.random() * 100) for e in "abc" for i in range(60)]
    df = spark.createDataFrame(rows, "e string, date date, gold double")
    cfg = FeatureConfig(entity=("e",), variables=("gold",))
    a = sorted(add_features(df, cfg, ["gold"]).collect())
    b = sorted(add_features(df.repartition(7).orderBy(F.rand(3)), cfg, ["gold"]).collect())
    assert a == b


def test_business_calendar(spark):
    days = [r.date for r in calendar(spark, "2025-11-20", "2025-11-26").orderBy("date").collect()]
    assert days == [dt.date(2025, 11, d) for d in (20, 21, 24, 25, 26)]


def test_dedupe_keep_last_and_first(spark):
    rows = [("2025-11-26", "15:44", 1, 10.0), ("2025-11-26", "15:44", 3, 30.0), ("2025-11-26", "15:44", 2, 20.0),
            ("2025-11-27", "09:00", 4, 40.0)]
    df = spark.createDataFrame(rows, "date string, t string, seq int, v double")
    last = {r.date: r.v for r in dedupe(df, ["date", "t"], "seq", "last").collect()}
    first = {r.date: r.v for r in dedupe(df, ["date", "t"], "seq", "first").collect()}
    assert last == {"2025-11-26": 30.0, "2025-11-27": 40.0}
    assert first == {"2025-11-26": 10.0, "2025-11-27": 40.0}


def test_dedupe_where_and_unique_keys(spark):
    rows = [(k % 5, i, float(i)) for i, k in enumerate(range(100))]
    df = spark.createDataFrame(rows, "k int, seq int, v double")
    out = dedupe(df, "k", "seq", "last", where=F.col("v") < 50).collect()
    assert sorted((r.k, r.seq) for r in out) == [(k, 45 + k) for k in range(5)]


def test_last_non_null_per_day(spark):
    rows = [("d1", "09:00", 5.0), ("d1", "17:00", None)]
    df = spark.createDataFrame(rows, "day string, t string, v double")
    assert last_non_null_per_group(df, ["day"], "t", ["v"]).first().v == 5.0


def test_asof_join(spark):
    left = spark.createDataFrame([(1, dt.date(2024, 1, 3)), (2, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 5))],
                                 "id int, date date")
    right = spark.createDataFrame([(dt.date(2024, 1, 2), 20.0), (dt.date(2024, 1, 5), 50.0)], "date date, v double")
    got = {r.id: r.v for r in asof_join(left, right, ["v"]).collect()}
    assert got == {1: 20.0, 2: None, 3: 50.0}


def test_asof_join_of_a_hot_entity(spark):
    from panelcast.operators.align import asof_join_split
    rng = random.Random(4)
    left = [(i, rng.choice(["hot"] * 8 + ["b", None]), rng.choice([None, 7, *range(400)])) for i in range(1500)]
    left += left[:20] + [(5000 + i, "hot", 7) for i in range(300)]
    right = [(rng.choice(["hot", "hot", "b", "c", None]), rng.choice([None, *range(0, 400, 3)]),
              rng.choice([None, rng.random()])) for _ in range(500)]

    def brute(keyed):
        out = []
        for i, e, t in left:
            old = [(rt, v is not None, v or 0.0, v) for re, rt, v in right
                   if (re == e or not keyed) and rt is not None and t is not None and rt <= t]
            out.append((i, e, t, max(old)[3] if old else None))
        return sorted(out, key=repr)
    lf = spark.createDataFrame(left, "id long, e string, t int").withColumn("_t", F.col("id"))
    rt = spark.createDataFrame(right, "e string, t int, v double")
    for keyed in (True, False):
        got = asof_join_split(lf, rt, ["v"], ["e"] if keyed else [], "t")
        assert got.columns == ["id", "e", "t", "_t", "v"]
        rows = got.collect()
        assert sorted(((r.id, r.e, r.t, r.v) for r in rows), key=repr) == brute(keyed)
        assert all(r._t == r.id for r in rows)
        assert asof_join_split(lf, rt.limit(0), ["v"], ["e"] if keyed else [], "t").where("v is not null").count() == 0
    assert asof_join_split(lf.limit(0), rt, ["v"], ["e"], "t").count() == 0


def test_split_and_folds(spark):
    df = _series(spark, [float(i) for i in range(13)])
    f = contiguous_folds(df, 5, ["e"]).orderBy("date").collect()
    assert pd.Series([r.fold for r in f]).value_counts().sort_index().tolist() == [3, 3, 3, 2, 2]
    s = chronological_split(_series(spark, [float(i) for i in range(10)]), 0.2, ["e"]).orderBy("date").collect()
    assert [r.split for r in s] == ["train"] * 8 + ["test"] * 2


def test_ffill_distributed_matches_window(spark):
    from panelcast.operators.align import ffill_distributed
    rng = random.Random(11)
    rows = []
    for e, n in (("hot", 3000), ("b", 40), ("c", 25)):
        for i in range(n):
            v = rng.random() if rng.random() < 0.2 else None
            rows.append((e, i, v))
    rows.append(("d", 0, None))                      # an entity that never has a value
    df = spark.createDataFrame(rows, "e string, t int, v double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")   # carry across Arrow batches too
    try:
        got = {(r.e, r.t): r.v for r in ffill_distributed(df, ["v"], ["e"], ["t"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exp = {(r.e, r.t): r.v for r in fill(df.withColumnRenamed("t", "date"), ["v"], ["e"], backward=False)
           .withColumnRenamed("date", "t").collect()}
    assert got == exp
    got_b = {(r.e, r.t): r.v for r in ffill_distributed(df, ["v"], ["e"], ["t"], backward=True).collect()}
    exp_b = {(r.e, r.t): r.v for r in fill(df.withColumnRenamed("t", "date"), ["v"], ["e"], backward=True)
             .withColumnRenamed("date", "t").collect()}
    assert got_b == exp_b


def test_features_distributed_matches_window(spark):
    from panelcast.operators.features import features_distributed
    rng = random.Random(5)
    rows = []
    for e, n in (("hot", 400), ("b", 23), ("c", 9), ("d", 1)):
        for i in range(n):
            rows.append((e, i, None if rng.random() < 0.15 else float(rng.randint(0, 5))))
    df = spark.createDataFrame(rows, "e string, t int, v double")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")            # many partitions with < K rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(features_distributed(df, ["v"], ["e"], ["t"]).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    cfg = FeatureConfig(entity=("e",), variables=("v",), target="none", time="t")
    exp = sorted(add_features(df, cfg, ["v"], target_next=False).collect())
    assert len(got) == len(exp) == len(rows)
    for a, b in zip(got, exp):
        assert a.asDict() == b.asDict()


def test_asof_join_per_entity_and_entity_calendar(spark):
    left = spark.createDataFrame([("a", 1, dt.date(2024, 1, 3)), ("a", 2, dt.date(2024, 1, 3)),
                                  ("b", 3, dt.date(2024, 1, 3)), ("b", 4, dt.date(2024, 1, 1))],
                                 "e string, id int, date date")
    right = spark.createDataFrame([("a", dt.date(2024, 1, 2), 20.0), ("b", dt.date(2024, 1, 3), 30.0),
                                   ("a", dt.date(2024, 1, 4), 40.0)], "e string, date date, v double")
    got = {r.id: r.v for r in asof_join(left, right, ["v"], ["e"]).collect()}
    assert got == {1: 20.0, 2: 20.0, 3: 30.0, 4: None}
    ents = spark.createDataFrame([("a",), ("b",)], "e string")
    cal = calendar(spark, "2025-11-21", "2025-11-24", None, entities=ents)
    assert sorted((r.e, r.date.day) for r in cal.collect()) == [(e, d) for e in "ab" for d in (21, 22, 23, 24)]


def test_sequences_distributed_matches_window(spark):
    """One entity holds most rows, one is null, some series are shorter than
    the length; values have nulls, and samples leave in small batches."""
    from panelcast.operators.features import sequences, sequences_distributed
    rows = [(None if i % 9 == 0 else "hot" if i % 9 < 7 else f"e{i % 5}", i * 7919 % 2003, None if i % 11 == 0 else float(i % 37))
            for i in range(900)]
    df = spark.createDataFrame(rows, "e string, t int, v double").withColumn("u", F.col("v") * 2)
    key = lambda r: repr(tuple(r))
    for entity, length in ((["e"], 5), ([], 30), (["e"], 400), (["e"], 5000)):
        want = sorted(sequences(df, ["v", "u"], length, "u", entity, "t").collect(), key=key)
        got = sorted(sequences_distributed(df, ["v", "u"], length, "u", entity, ["t"], batch_rows=16).collect(), key=key)
        assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert sequences_distributed(df.limit(0), ["v"], 5, order=["t"]).count() == 0
