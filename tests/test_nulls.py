"""A NULL entity is an entity: one test for each operator that joins on it."""

from pyspark.sql import functions as F

from panelcast.operators import align, dedupe, features, split, stats
from panelcast.operators.quality import Rule, evaluate
from panelcast.streaming.ingest import history_sink


def _two(spark, n=20):
    """Entities NULL and 'a' with the same values in the same order."""
    return spark.createDataFrame([(e, i, float((i * 7) % 5)) for e in (None, "a") for i in range(n)],
                                 "e string, date int, v double")


def _same(df, key="e"):
    rows = [r.asDict() for r in df.collect()]
    pick = lambda null: sorted(repr(sorted((k, v) for k, v in r.items() if k != key))
                               for r in rows if (r[key] is None) == null)
    assert pick(True) == pick(False) and pick(True)
    return rows


def test_summary_outliers_and_descriptive(spark):
    d = _two(spark)
    rows = _same(stats.measurement_summary(d, "v", ["e"]))
    assert all(r["p50"] is not None for r in rows)
    odd = d.unionByName(spark.createDataFrame([(e, 99, 1e9) for e in (None, "a")], d.schema))
    assert sum(r["is_outlier"] for r in _same(stats.outlier_flags(odd, "v", ["e"]))) == 2
    assert all(r["median"] == 2.0 for r in _same(stats.descriptive_stats(d, "v", ["e"])))


def test_checks_drop_last_and_scale(spark):
    d = _two(spark).withColumn("seq", -F.col("date"))
    assert not any(r["monotonic"] for r in _same(split.series_checks(d, "date", "seq", ["e"])))
    assert len(_same(dedupe.drop_last_row(d, "date", ["e"]))) == 38
    assert {r["v_scaled"] for r in _same(features.minmax_scale(d, ["v"], ["e"]))} > {0.0, 1.0}


def test_asof_keeps_types_and_null_entities(spark):
    left = spark.createDataFrame([(e, i) for e in (None, "a") for i in (1, 5)], "e string, date int")
    right = spark.createDataFrame([(e, 2, "x", 7) for e in (None, "a")], "e string, date int, s string, n bigint")
    out = align.asof_join(left, right, ["s", "n"], ["e"])
    assert dict(out.dtypes)["s"] == "string" and dict(out.dtypes)["n"] == "bigint"
    assert [r["s"] for r in _same(out) if r["date"] == 5] == ["x", "x"]


def test_distributed_fill(spark):
    d = _two(spark, 400).withColumn("v", F.when(F.col("date") % 50 == 0, F.col("date").cast("double")))
    rows = _same(align.ffill_distributed(d.repartition(4), ["v"], ["e"]))
    assert all(r["v"] == r["date"] // 50 * 50 for r in rows)


def test_distinct_keys_with_nulls_are_no_duplicates(spark):
    from panelcast.operators.quality import feature_store_rules
    d = spark.createDataFrame([(None, 1.0), (1, 2.0)], "date int, v double")
    rules = [r for r in feature_store_rules(d) if r.name == "unique_key"]
    assert [r.status for r in evaluate(d, rules).collect()] == ["PASS"] and isinstance(rules[0], Rule)


def test_replayed_epoch_replaces_its_row(spark, tmp_path):
    write = history_sink(str(tmp_path / "h"), "v")
    batch = spark.createDataFrame([(1.0, 1), (3.0, 2)], "v double, ts int")
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(str(tmp_path / "h")).count() == 2
