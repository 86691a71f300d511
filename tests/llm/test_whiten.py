import numpy as np
import pytest

from panelcast.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x int, fit boolean, b int"


def table(spark, vectors, start=0):
    return spark.createDataFrame([(start + i, v, None, "q", 1, True, 2) for i, v in enumerate(vectors)], SCHEMA)


def brute(vectors):
    x = [None if v is None or any(c is None or not np.isfinite(c) for c in v) else
         [int(np.floor(256 * float(np.float32(c)))) for c in v] for v in vectors]
    d = max((len(v) for v in x if v is not None), default=0)
    x = [None if v is None else v + [0] * (d - len(v)) for v in x]
    fit = sorted({tuple(v) for v in x if v is not None})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(c) - t / n for c, t in zip(v, s, strict=True)] for v in fit])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    return x, n, s, e[::-1], u[:, ::-1], np.trace(cov)


def compare(spark, vectors, parts=3):
    out = whiten.report(table(spark, vectors).repartition(parts))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x, n, s, e, u, trace = brute(vectors)
    got = {(r["vec_id"], r["component"]): r for r in out.collect()}
    k = min(4, len(s))
    assert set(got) == {(i, c + 1) for i, v in enumerate(x) if v is not None for c in range(k)}
    mean = np.array([t / n for t in s])
    for c in range(k):
        want = {i: float((np.array(v) - mean) @ u[:, c] / np.sqrt(e[c])) for i, v in enumerate(x) if v is not None}
        sign = np.sign(sum(want[i] * got[i, c + 1]["whitened"] for i in want))
        for i, w in want.items():
            r = got[i, c + 1]
            assert r["whitened"] == pytest.approx(sign * w, rel=1e-6, abs=1e-6)
            assert r["n"] == n and r["explained"] == pytest.approx(e[c] / trace, rel=1e-9)
            assert r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x[i], s, strict=True))
            assert r["identity_error"] < 1e-9


def test_against_numpy(spark):
    rng = np.random.default_rng(4)
    v = (rng.standard_normal((3000, 7)) @ rng.standard_normal((7, 7)) * 0.2).tolist()
    v += [v[0]] * 1500 + [v[1]] * 2                     # a hot vector: copies count once
    v += [None, [None] + v[2][1:], [float("nan")] + v[2][1:], [float("inf")] + v[2][1:], [-0.0] * 7, [0.0] * 7, v[5][:3], []]
    compare(spark, v)


def test_blocks_and_groups(spark, monkeypatch):
    """Many blocks, several groups of blocks."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(whiten, "BLOCK_ROWS", (16, 16))
    monkeypatch.setattr(whiten, "GROUP_BLOCKS", 3)
    compare(spark, (rng.standard_normal((500, 5)) * [5, 2, 1, 0.5, 0.3]).tolist(), parts=7)


def test_few_dimensions_and_no_variance(spark):
    out = whiten.report(table(spark, [[1.0, 2.0], [1.0, 2.0]])).collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in
            sorted(out, key=lambda r: (r["vec_id"], r["component"]))] == [
                (i, c, 1, 0, None, 0.0) for i in range(2) for c in (1, 2)]
    assert whiten.report(table(spark, [])).collect() == []
    assert whiten.report(table(spark, [None, [None]])).collect() == []
    assert whiten.report(table(spark, [[], []])).collect() == []


def test_large_entries(spark):
    """Sums and distances beyond 64 bits: exact, null where they don't fit."""
    out = whiten.report(table(spark, [[1e18, 0.0], [-1e18, 1.0], [1e30, 2.0]])).collect()
    assert {r["deviation"] for r in out} == {None} and {r["n"] for r in out} == {3}


def test_keys_of_any_type(spark):
    d = spark.createDataFrame([("a", [1.0, 2.0]), (None, [3.0, 1.0]), ("a", [0.0, 5.0])], "vec_id string, embedding array<double>")
    assert sorted(whiten.report(d).select("vec_id", "component").collect(), key=repr) == sorted(
        [(i, c) for i in ("a", None, "a") for c in (1, 2)], key=repr)
