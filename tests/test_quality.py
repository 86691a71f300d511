"""Quality rules: readiness statuses, acceptance rules, health summary."""

import datetime as dt

from panelcast.operators import quality as QL


def test_readiness_statuses(spark):
    rows = [(1.0, None, None), (2.0, None, 3.0), (3.0, None, None)]
    df = spark.createDataFrame(rows, "gold double, fx double, oil double")
    got = {r.feature: r.status for r in QL.readiness(df, ["gold", "fx", "oil", "btc"]).collect()}
    assert got == {"gold": "OK", "fx": "ALL_NULL", "oil": "HIGH_NULL", "btc": "MISSING"}


def test_acceptance_rules(spark):
    d0 = dt.date(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=i * 10 if i < 3 else 30 + i), float(1000 * i)) for i in range(600)]
    rows.append(rows[-1])                                # one duplicate date
    res = {r.rule: (r.status, r.detail) for r in QL.acceptance_rules(
        spark.createDataFrame(rows, "date date, gold double"), "gold").collect()}
    assert res["min_rows"][0] == "PASS" and res["min_std"][0] == "PASS"
    assert res["no_duplicates"] == ("FAIL", "1")
    assert res["few_gaps"] == ("PASS", "3")              # three steps of more than 7 days


def test_health_summary(spark):
    rows = [("a", "PASS", ""), ("b", "WARN", "x"), ("c", "PASS", "")]
    df = spark.createDataFrame(rows, "rule string, status string, detail string")
    r = QL.health_summary(df).first()
    assert (r.PASS, r.WARN, r.FAIL, r.overall) == (2, 1, 0, "DEGRADED")
