"""Sources: newest snapshot by modification time and by name, JSON records,
HTML rows, upsert keep-last."""

import time
import uuid

import pytest

from pyspark.sql import functions as F

from panelcast.session import scratch_path
from panelcast.sources import files as FI
from panelcast.sources import json as J
from panelcast.sources import upsert as U


@pytest.mark.parametrize("parts", [1, 4])
def test_latest_snapshot_by_mtime_and_name(spark, parts):
    base = scratch_path(spark, f"test-snap-{uuid.uuid4().hex}")
    # written second but named first: mtime and name disagree on purpose
    FI.write_csv(spark.range(100).selectExpr("int(id) AS id", "1.0D AS v").repartition(parts), f"{base}/b_snap", decimals=None)
    time.sleep(1.2)
    FI.write_csv(spark.range(200, 240).selectExpr("int(id) AS id", "3.0D AS v").repartition(parts), f"{base}/a_snap", decimals=None)
    scan = FI.read_csv(spark, f"{base}/*_snap", schema="id INT, v DOUBLE", with_file=True)
    assert sorted(r.id for r in FI.latest_snapshot_rows(scan, "mtime").collect()) == list(range(200, 240))
    assert sorted(r.id for r in FI.latest_snapshot_rows(scan, "name").collect()) == list(range(100))
    assert FI.latest_snapshot_rows(scan, "name", unit="file").count() == 100 // parts


def test_json_records_and_missing_keys(spark):
    docs = spark.createDataFrame([(1, '{"response": {"data": [{"period": "2024-01", "value": 1.5}, '
                                      '{"period": "2024-02"}]}}'), (2, '{"response": {}}'), (3, "not json")],
                                 "id int, doc string")
    rows = J.explode_records(docs, "doc", "struct<response: struct<data: array<struct<period: string, "
                                          "value: double>>>>", "response.data", keep=["id"]).collect()
    assert sorted((r.id, r.period, r.value) for r in rows) == [(1, "2024-01", 1.5), (1, "2024-02", None)]


def test_html_rows_zero_tables(spark):
    pages = spark.createDataFrame([(1, "<html><p>no table</p></html>"),
                                   (2, "<table><tr><td>a</td><td><b>b</b></td></tr><tr><td>c</td></tr></table>")],
                                  "id int, html string")
    rows = J.html_table_rows(pages, "html", n_cells=2, keep=["id"]).collect()
    assert [(r.id, r.cells) for r in rows] == [(2, ["a", "b"])]


def test_upsert_new_rows_win(spark):
    old = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, v double")
    new = spark.createDataFrame([(2, 25.0, "x"), (3, 30.0, "y")], "k int, v double, tag string")
    got = {r.k: (r.v, r.tag) for r in U.upsert_tagged(old, new, "k").collect()}
    assert got == {1: (10.0, None), 2: (25.0, "x"), 3: (30.0, "y")}
