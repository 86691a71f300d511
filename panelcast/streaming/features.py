"""Streaming feature path (T1-T3): per-entity state of the last ``context``
values, so every arriving tick gets its lag / rolling / change features
without re-reading history.

``applyInPandasWithState`` keeps, per entity, the last ``context`` values and
the newest event time.  Entities are dealt to buckets by a hash, and a bucket's
ticks are computed in one call, since a call for each entity and micro-batch
costs far more than its few rows.  Within a micro-batch the rows of an entity are
processed in event-time order; a row older than the newest one already
seen is emitted with ``late = true`` and does not enter the state (the
late side table).  With in-order input the output equals the batch window
computation (W1, W3, W4) over the whole history.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..config import LAGS, ROLL_MIN_PERIODS, ROLL_WINDOW

CONTEXT_ROWS = 14   # rows kept per entity (the reference's context length)
BUCKETS = 4096      # of entities whose ticks are computed together; fixed when the query first starts
_NO_TIME, _LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

# PySpark's state serializer pads batches with empty frames, which pandas 2.x
# reports as a FutureWarning on every micro-batch; it is not actionable here.
warnings.filterwarnings("ignore", category=FutureWarning, module="pyspark.sql.pandas.serializers")


def feature_schema(entity: str, time: str, value: str, lags: Sequence[int]) -> str:
    cols = [f"{entity} bigint", f"{time} timestamp_ntz", f"{value} double"]
    cols += [f"{value}_lag{k} double" for k in lags]
    cols += [f"{value}_roll7_mean double", f"{value}_pct_change double", "late boolean"]
    return ", ".join(cols)


def _features(x: np.ndarray, place: np.ndarray, lags: Sequence[int], roll: int, minp: int) -> np.ndarray:
    """Features of the values ``x`` of entities one after another, in time
    order; ``place`` is a value's position in its entity.  Returns an array
    (rows x (len(lags) + 2)): lags, rolling mean of the finite values, change."""
    def back(k: int) -> np.ndarray:
        out = np.full(len(x), np.nan)
        out[k:] = x[:len(x) - k] if k < len(x) else x[:0]
        out[place < k] = np.nan
        return out

    prev = back(1)
    cols = [back(k) for k in lags]
    total, count = np.zeros(len(x)), np.zeros(len(x))
    for k in reversed(range(roll)):
        v = back(k)
        ok = np.isfinite(v)
        total += np.where(ok, v, 0.0)
        count += ok
    with np.errstate(divide="ignore", invalid="ignore"):
        cols.append(np.where(count >= max(minp, 1), total / count, np.nan))
        cols.append(x / np.where(prev != 0, prev, np.nan) - 1.0)
    return np.stack(cols, 1)


def stream_features(events: DataFrame, entity: str, time: str, value: str, lags: Sequence[int] = LAGS,
                    roll: int = ROLL_WINDOW, min_periods: int = ROLL_MIN_PERIODS,
                    context: int = CONTEXT_ROWS, idle_timeout: str | None = None,
                    watermark: str = "1 day", buckets: int = BUCKETS) -> DataFrame:
    """T3 on a streaming DataFrame of ``(entity, time, value)``.

    ``idle_timeout`` (e.g. ``"30 days"``) bounds the state to active
    entities: the input gets ``withWatermark(time, watermark)`` and an
    entity's state is dropped once the watermark passes its last tick plus
    the timeout (a returning entity then starts without history).
    """
    keep = max(context, roll, max(lags))
    schema = feature_schema(entity, time, value, lags)
    idle_ms = _interval_ms(idle_timeout) if idle_timeout else None

    feat_cols = [*[f"{value}_lag{k}" for k in lags], f"{value}_roll7_mean", f"{value}_pct_change"]

    def load(state) -> dict[tuple, tuple[list[float], int]]:
        """(null or not, entity) -> its last values and newest time."""
        if not state.exists:
            return {}
        ids, none, sizes, last, vals = state.get
        ends = np.cumsum(sizes).tolist()
        return {(m, i): (list(vals[e - n:e]), t) for i, m, n, t, e in zip(ids, none, sizes, last, ends, strict=True)}

    def store(state, known: dict, seen=()) -> None:
        """Keeps the state of entities that are not idle or were just seen."""
        if idle_ms is not None:
            now = state.getCurrentWatermarkMs()
            known = {k: v for k, v in known.items() if k in seen or v[1] // 1000 + idle_ms >= now}
        if not known:
            state.remove()
            return
        state.update(([i for _, i in known], [m for m, _ in known], [len(v) for v, _ in known.values()],
                      [t for _, t in known.values()], [x for v, _ in known.values() for x in v]))
        if idle_ms is not None:
            state.setTimeoutTimestamp(max(min(t for _, t in known.values()) // 1000 + idle_ms, now + 1))

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = load(state)
        if state.hasTimedOut:
            store(state, known)
            return
        pdf = pd.concat(list(batches), ignore_index=True)
        at = pdf[time].to_numpy().astype("datetime64[us]").astype(np.int64)
        order = np.lexsort((np.where(at == _NO_TIME, _LAST, at), pdf["_id"], pdf["_none"]))
        pdf, at = pdf.iloc[order], at[order]
        ids, none, x = pdf["_id"].to_numpy(np.int64), pdf["_none"].to_numpy(bool), pdf[value].to_numpy(float)
        first = np.concatenate([[True], (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])])
        owner = np.cumsum(first) - 1
        users = list(zip(none[first].tolist(), ids[first].tolist(), strict=True))
        hist = [known[u][0] if u in known else [] for u in users]
        last = np.array([known[u][1] if u in known else _NO_TIME for u in users], np.int64)
        late = (at != _NO_TIME) & (at < last[owner])
        # One series for each entity's rows in time, after its stored values; a late row is scored
        # against the stored values on its own and does not enter the state (the late side table).
        on_time, behind = np.flatnonzero(~late), np.flatnonzero(late)
        fresh = np.bincount(owner[on_time], minlength=len(users))
        whose = np.concatenate([np.arange(len(users)), owner[behind]])
        stored = np.array([len(h) for h in hist])[whose]
        size = stored + np.concatenate([fresh, np.ones(len(behind), np.int64)])
        start = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(start, size)
        new = place >= np.repeat(stored, size)
        rows = np.concatenate([on_time, behind])
        series = np.empty(len(place))
        series[new] = x[rows]
        series[~new] = [v for u in whose.tolist() for v in hist[u]]
        f = _features(series, place, lags, roll, min_periods)[new]
        ends = np.cumsum(fresh) - 1
        for u in np.flatnonzero(fresh).tolist():
            known[users[u]] = (series[start[u]:start[u] + size[u]][-keep:].tolist(), int(at[on_time[ends[u]]]))
        store(state, known, set(users))
        yield pd.DataFrame({entity: pd.arrays.IntegerArray(ids[rows], none[rows]), time: pdf[time].to_numpy()[rows], value: x[rows],
                            **dict(zip(feat_cols, f.T, strict=True)), "late": late[rows]})

    src = events.select(entity, time, value)
    timeout = GroupStateTimeout.NoTimeout
    if idle_ms is not None:
        # watermarks need TIMESTAMP; the session zone is pinned to UTC, so
        # the cast keeps the instant of a TIMESTAMP_NTZ tick time
        src = src.withColumn("_event_time", F.col(time).cast("timestamp")).withWatermark("_event_time", watermark)
        timeout = GroupStateTimeout.EventTimeTimeout
    src = (src.withColumn("_id", F.coalesce(F.col(entity).cast("long"), F.lit(0))).withColumn("_none", F.col(entity).isNull())
           .withColumn("_bucket", F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")))
    return src.groupBy("_bucket").applyInPandasWithState(
        step, schema, "ids array<bigint>, none array<boolean>, sizes array<int>, last array<bigint>, vals array<double>",
        "append", timeout)


def _interval_ms(text: str) -> int:
    """``"30 days"`` / ``"12 hours"`` / ``"90 minutes"`` -> milliseconds."""
    n, unit = text.split()
    scale = {"day": 86_400_000, "hour": 3_600_000, "minute": 60_000, "second": 1_000}[unit.rstrip("s")]
    return int(float(n) * scale)
