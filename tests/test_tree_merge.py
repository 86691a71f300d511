"""Linear statistics are merged as a tree; split and folds are one projection."""

from pyspark.sql import functions as F

from panelcast.models import linear as LIN
from panelcast.operators.split import chronological_split, contiguous_folds, series_checks, split_and_folds


def test_partial_rows_do_not_grow_with_batches(spark):
    d = spark.range(4000, numPartitions=4).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("e"), (F.col("id") % 3).cast("string"))).alias("e"),
        (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 17 * 2 + 1).cast("double").alias("y"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        parts = LIN.partial_stats(d, ["x"], "y", ["e"])
        assert parts.count() <= 4 * 3                      # tasks x keys, not batches x keys
        assert sum(r["stats"][0] for r in parts.collect()) == 4000
        fits = LIN.fit_linear(d, ["x"], "y", ["e"]).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r["e"] for r in fits} == {None, "e1", "e2"}
    assert all(abs(r["coef"][0] - 2) < 1e-9 and abs(r["intercept"] - 1) < 1e-9 for r in fits)


def test_split_and_folds_equal_the_two_steps(spark):
    d = spark.createDataFrame([(e, i) for e, n in ((None, 1), ("a", 3), ("b", 23), ("c", 40)) for i in range(n)],
                              "e string, date int")
    both = {(r["e"], r["date"]): (r["split"], r["fold"]) for r in split_and_folds(d, 0.2, 5, ["e"]).collect()}
    s = chronological_split(d, 0.2, ["e"])
    train = contiguous_folds(s.where("split = 'train'"), 5, ["e"])
    want = {(r["e"], r["date"]): ("test", None) for r in s.where("split = 'test'").collect()}
    want |= {(r["e"], r["date"]): ("train", r["fold"]) for r in train.collect()}
    assert both == want


def test_order_is_unknown_without_an_arrival_column(spark):
    assert [r["monotonic"] for r in series_checks(spark.createDataFrame([(2,), (1,)], "date int")).collect()] == [None]
