"""Golden test against the reference's published monitoring report.

Input: the reference's seeded demonstration series - 50 daily rows from
2025-10-01, actual = 60000 + cumsum(randn * 100), predicted = actual +
randn * 300 with numpy seed 42.  Expected values are the published numbers
of that run (fixed values, copied as text).
"""

import datetime as dt

import numpy as np
import pytest

from panelcast.config import MonitorConfig
from panelcast.operators.monitor import monitoring_report, moving_average_accuracy

# Published report of the seeded demonstration run.
PUBLISHED = {
    "data_points": 50,
    "current_7d": 99.78346022648876,
    "current_30d": 99.6579471296879,
    "decay_rate_7d": -0.033743031497195375,
    "decay_rate_30d": -0.006829086653809213,
    "is_declining_7d": False,
    "is_declining_30d": False,
    "drift_detected_7d": False,
    "drift_detected_30d": False,
    "severity_7d": "LOW",
    "severity_30d": "LOW",
    "balance_index": 0.04,
    "bias": "BALANCED",
    "speed": "STABLE",
    "variance": 0.0012071833020576355,
    "trend": "IMPROVING",
    "slope": 0.0016940416800882692,
    "recommendations": ["✅ Model performance is stable."],
}
# The first published moving-average accuracy rows (7d, 30d).
PUBLISHED_MACC_HEAD = [
    (dt.date(2025, 10, 1), 99.8380920519181, 99.8380920519181),
    (dt.date(2025, 10, 2), 99.82283293513521, 99.82283293513521),
    (dt.date(2025, 10, 3), 99.76925716143552, 99.76925716143552),
    (dt.date(2025, 10, 4), 99.75080428048096, 99.75080428048096),
]


def _seeded_predictions(spark):
    n = 50
    rng = np.random.RandomState(42)
    actual = 60000 + np.cumsum(rng.randn(n) * 100)
    predicted = actual + rng.randn(n) * 300
    rows = [(dt.date(2025, 10, 1) + dt.timedelta(days=i), float(a), float(p))
            for i, (a, p) in enumerate(zip(actual, predicted))]
    return spark.createDataFrame(rows, "date date, actual double, predicted double")


def test_monitoring_report_matches_published(spark):
    r = monitoring_report(_seeded_predictions(spark), MonitorConfig()).first().asDict()
    for k, v in PUBLISHED.items():
        if isinstance(v, float):
            assert r[k] == pytest.approx(v, rel=1e-9, abs=1e-12), k
        else:
            assert r[k] == v, k
    assert r["start"] == dt.date(2025, 10, 1) and r["end"] == dt.date(2025, 11, 19)


def test_moving_accuracy_matches_published(spark):
    m = moving_average_accuracy(_seeded_predictions(spark), (7, 30)).orderBy("date").collect()
    assert len(m) == 50
    for (d, a7, a30), row in zip(PUBLISHED_MACC_HEAD, m):
        assert row.date == d
        assert row.MAcc_7d == pytest.approx(a7, rel=1e-12)
        assert row.MAcc_30d == pytest.approx(a30, rel=1e-12)


# The published 7-day forecast (date, day name, predicted
# price, change, change %), Sunday closed.
PUBLISHED_FORECAST = [
    ("2025-11-19", "Wednesday", 61728.50230629063, 154.5923062906295, 0.25106787321225743),
    ("2025-11-20", "Thursday", 61874.37083717109, 145.8685308804561, 0.2363066094762369),
    ("2025-11-21", "Friday", 62015.5501918538, 141.17935468271025, 0.2281709741408742),
    ("2025-11-22", "Saturday", 62152.44998624562, 136.89979439182207, 0.22075075359051619),
    ("2025-11-24", "Monday", 62285.218390470596, 132.7684042249748, 0.21361733005594558),
    ("2025-11-25", "Tuesday", 62413.98139407629, 128.7630036056944, 0.20673123886067105),
    ("2025-11-26", "Wednesday", 62538.859926556375, 124.87853248008469, 0.2000810230188855),
]


def test_forecast_bookkeeping_matches_published(spark):
    """Dates (next open day, Sunday closed), day names and the change chain
    of the published forecast, recomputed with the library's functions."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from panelcast.functions import dates as D
    from panelcast.functions import numbers as N
    first_last = PUBLISHED_FORECAST[0][2] - PUBLISHED_FORECAST[0][3]
    rows = [(i, p[2]) for i, p in enumerate(PUBLISHED_FORECAST)]
    df = spark.createDataFrame(rows, "step int, predicted double")
    w = Window.orderBy("step")
    prev = F.coalesce(F.lag("predicted").over(w), F.lit(first_last))
    out = df.select("step", "predicted", N.change("predicted", prev).alias("change"),
                    N.change_pct("predicted", prev).alias("change_pct")).orderBy("step").collect()
    for r, p in zip(out, PUBLISHED_FORECAST):
        assert r.change == pytest.approx(p[3], rel=1e-9)
        assert r.change_pct == pytest.approx(p[4], rel=1e-9)
    # the date chain from the last observed day, Tuesday 2025-11-18
    d = spark.createDataFrame([(dt.date(2025, 11, 18),)], "d date")
    chain = []
    for _ in range(7):
        nxt = d.select(D.next_open_day("d", [6]).alias("d"), ).first().d
        chain.append(nxt)
        d = spark.createDataFrame([(nxt,)], "d date")
    names = spark.createDataFrame([(c,) for c in chain], "d date").select(
        D.weekday_name("d").alias("n"), D.is_open_day("d", [6]).alias("o")).collect()
    assert [c.isoformat() for c in chain] == [p[0] for p in PUBLISHED_FORECAST]
    assert [r.n for r in names] == [p[1] for p in PUBLISHED_FORECAST]
    assert all(r.o for r in names)
