"""Leaf-wise histogram boosting with shared cross-validation (M6, M7).

Features are binned once.  A tree grows best leaf first: the histograms (sum of
gradients and rows by node, feature and bin) of all leaves that could be split
next come from one aggregate over the rows, each time of the smaller child only,
the larger one being the difference from the parent.  A round of this costs one
Spark job, whatever the number of leaves, and a tree needs about as many rounds
as it is deep.  The models of the cross-validation folds grow beside the model
of all rows: a row's fold says which of them it belongs to, and one pass serves
all.  What a task sends grows with leaves x features x bins, not with rows, and
is added up in a tree.

Squared loss: a node's value is the mean residual (shrunk by ``l2``) times the
learning rate; the gain of a split is the fall in squared loss.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 255
BLOCK_ROWS = 1 << 16
CHECKPOINT_TREES = 25    # lineage of the residuals is cut after so many trees


@dataclass(frozen=True)
class BoostConfig:
    trees: int = 500
    learning_rate: float = 0.05
    max_leaves: int = 31
    max_depth: int = 0               # 0: no limit
    min_leaf_rows: int = 20
    l2: float = 0.0
    row_share: float = 0.9           # of the rows, drawn anew for each tree
    column_share: float = 0.9        # of the features, drawn anew for each tree
    seed: int = 42


@dataclass
class Tree:
    """Nodes by number, the root first; feature -1 marks a leaf."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def grow(self, node: int, feature: int, at: int) -> tuple[int, int]:
        k = len(self.feature)
        for _ in range(2):
            for name, v in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("value", 0.0), ("depth", self.depth[node] + 1)):
                getattr(self, name).append(v)
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, at, k, k + 1
        return k, k + 1

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        f, b, lo, hi = (np.array(v) for v in (self.feature, self.bin, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = f[at] >= 0
            if not inner.any():
                return at
            i, n = rows[inner], at[inner]
            at[i] = np.where(bins[i, f[n]] <= b[n], lo[n], hi[n])

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves_of(bins)]


@dataclass(frozen=True)
class Boosted:
    """``edges``: upper bin limits of each feature; ``models``: for the fit on
    all rows (-1) and without each fold, the start value and the trees."""
    features: tuple[str, ...]
    edges: list[np.ndarray]
    models: dict[int, tuple[float, list[Tree]]]
    gains: dict[str, float]

    def importances(self) -> list[tuple[str, float]]:
        """Each feature's share of the gain of all splits of the model of all rows."""
        total = sum(self.gains.values()) or 1.0
        return sorted(((f, g / total) for f, g in self.gains.items()), key=lambda x: (-x[1], x[0]))


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper limits of at most ``bins`` bins of each feature: quantiles, so a
    feature of few values has one bin for each.  One aggregate."""
    at = [(i + 1) / bins for i in range(bins)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), at, 10_000).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [0.0], float))[:-1] for i in range(len(features))]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], 1).astype(np.uint8)


def _blocks(df: DataFrame, features: Sequence[str], label: str, fold: str | None, row_id: Sequence[str], edges: list[np.ndarray],
            rows: int):
    """RDD of (bins, label, fold, row hash) arrays, some 65,000 rows each."""
    n = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done():
            t = pa.Table.from_batches(held)
            x = np.stack([t.column(f"x{i}").to_numpy() for i in range(n)], 1)
            cols = [binned(x, edges).tobytes(), t.column("y").to_numpy().tobytes(),
                    t.column("f").to_numpy().astype(np.int32).tobytes(), t.column("r").to_numpy().tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cols], names=["b", "y", "f", "r"])
        for b in batches:
            held.append(b)
            size += len(b)
            if size >= BLOCK_ROWS:
                yield done()
                held, size = [], 0
        if size:
            yield done()

    d = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"),
                  (F.col(fold) if fold else F.lit(-1)).cast("int").alias("f"), F.xxhash64(*row_id).alias("r")).dropna()
    # Few rows make few tasks: what a task sends does not depend on its rows.
    out = d.coalesce(max(1, -(-rows // BLOCK_ROWS))).mapInArrow(run, "b binary, y binary, f binary, r binary")
    return out.rdd.map(lambda r: (np.frombuffer(r.b, np.uint8).reshape(-1, n), np.frombuffer(r.y), np.frombuffer(r.f, np.int32),
                                  np.frombuffer(r.r, np.int64)))


def _drawn(rows: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Rows of a tree's sample, by a hash of row and tree."""
    if share >= 1:
        return np.ones(len(rows), bool)
    x = rows.view(np.uint64) ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * (1 << 64)) - 1)


def columns_of(tree: int, n: int, share: float, seed: int) -> np.ndarray:
    k = max(1, round(share * n))
    return np.sort(np.random.default_rng([seed, tree]).permutation(n)[:k])


def histogram(bins: np.ndarray, residual: np.ndarray, slot: np.ndarray, slots: int, width: int) -> np.ndarray:
    """(slots, features, width, 2): sum of residuals and rows."""
    n, k = bins.shape
    out = np.zeros((slots, k, width, 2))
    for f in range(k):
        at = slot * width + bins[:, f]
        out[:, f, :, 0] = np.bincount(at, residual, slots * width).reshape(slots, width)
        out[:, f, :, 1] = np.bincount(at, minlength=slots * width).reshape(slots, width)
    return out


def best_split(h: np.ndarray, columns: np.ndarray, cfg: BoostConfig) -> tuple[float, int, int] | None:
    """(gain, feature, last bin of the left side) of a node's histogram; ties
    go to the first feature and bin."""
    g, c = np.cumsum(h[columns, :, 0], 1), np.cumsum(h[columns, :, 1], 1)
    total, rows = g[:, -1:], c[:, -1:]
    right, rest = total - g, rows - c
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (c + cfg.l2) + right * right / (rest + cfg.l2) - total * total / (rows + cfg.l2)
    gain = np.where((c >= cfg.min_leaf_rows) & (rest >= cfg.min_leaf_rows), gain, -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    # Sums differ in their last bits with the order of the rows: a gain below that is none.
    return (float(gain[f, b]), int(columns[f]), b) if gain[f, b] > 1e-9 * max(1.0, abs(float(h[0, :, 0].sum()))) else None


class _Growing:
    """One tree on its way: histograms of its leaves, and of the children of
    leaves that may be split next."""

    def __init__(self, cfg: BoostConfig, columns: np.ndarray):
        self.cfg, self.columns, self.tree = cfg, columns, Tree()
        self.hist: dict[int, np.ndarray] = {}
        self.split: dict[int, tuple[float, int, int] | None] = {}
        self.leaves, self.ahead, self.done = [0], {}, False
        self.wanted, self.gains = [0], {}

    def learn(self, found: dict[int, np.ndarray]) -> None:
        """Histograms of the wanted nodes; their siblings by subtraction."""
        for node, h in found.items():
            self._keep(node, h)
        for parent, (small, large) in self.ahead.items():
            if small in found:
                self._keep(large, self.hist[parent] - found[small])
        self._advance()

    def _keep(self, node: int, h: np.ndarray) -> None:
        self.hist[node] = h
        deep = self.cfg.max_depth and self.tree.depth[node] >= self.cfg.max_depth
        self.split[node] = None if deep else best_split(h, self.columns, self.cfg)

    def _advance(self) -> None:
        while len(self.leaves) < self.cfg.max_leaves:
            able = [n for n in self.leaves if self.split[n]]
            if not able:
                break
            best = max(able, key=lambda n: (self.split[n][0], -n))
            if best not in self.ahead:
                # Look ahead in one job: at this leaf and at others, children of
                # leaves not yet split among them, as many as can still be split.
                room = self.cfg.max_leaves - len(self.leaves)
                able = [n for n in self.split if self.split[n] and n not in self.ahead and n != best]
                able.sort(key=lambda n: (-self.split[n][0], n))
                self.wanted = []
                for n in [best, *able[:room - 1]]:
                    _gain, f, b = self.split[n]
                    lo, hi = self.tree.grow(n, f, b)
                    left = self.hist[n][f, :b + 1, 1].sum()
                    small = lo if 2 * left <= self.hist[n][f, :, 1].sum() else hi
                    self.ahead[n] = (small, lo + hi - small)
                    self.wanted.append(small)
                return
            self.leaves.remove(best)
            self.leaves += sorted(self.ahead[best])
            f = self.split[best][1]
            self.gains[f] = self.gains.get(f, 0.0) + self.split[best][0]
            del self.hist[best]
        self._finish()

    def _finish(self) -> None:
        """The tree of the nodes that were split, numbered anew."""
        self.done, self.wanted = True, []
        t, leaves, out = self.tree, set(self.leaves), Tree()
        todo = [(0, 0)]
        while todo:
            n, k = todo.pop()
            if n in leaves:
                g, c = self.hist[n][0, :, 0].sum(), self.hist[n][0, :, 1].sum() + self.cfg.l2
                out.value[k] = float(self.cfg.learning_rate * g / c) if c > 0 else 0.0
            else:
                lo, hi = out.grow(k, t.feature[n], t.bin[n])
                todo += [(t.left[n], lo), (t.right[n], hi)]
        self.tree, self.hist, self.split = out, {}, {}


def _pass(rdd, growing: dict[int, _Growing], tree: int, cfg: BoostConfig, n_features: int, width: int) -> dict[int, dict[int, np.ndarray]]:
    """Histograms of all wanted nodes of all models: one job."""
    jobs = [(m, g.tree, np.array(g.wanted)) for m, g in sorted(growing.items()) if not g.done]
    shapes = [len(w) for _, _, w in jobs]

    def add(total, block):
        if total is None:
            total = np.zeros((sum(shapes), n_features, width, 2))
        bins, _y, folds, rows, residual = block
        drawn = _drawn(rows, tree, cfg.row_share, cfg.seed)
        at = 0
        for m, t, wanted in jobs:
            leaf = t.leaves_of(bins)
            slot = np.full(len(t.feature), -1)
            slot[wanted] = np.arange(len(wanted))
            s = slot[leaf]
            use = drawn & (folds != m) & (s >= 0) if m >= 0 else drawn & (s >= 0)
            if use.any():
                total[at:at + len(wanted)] += histogram(bins[use], residual[m][use], s[use], len(wanted), width)
            at += len(wanted)
        return total

    total = rdd.treeAggregate(None, add, lambda a, b: b if a is None else a if b is None else a + b, depth=2)
    out, at = {}, 0
    for (m, _t, wanted), n in zip(jobs, shapes, strict=True):
        out[m] = {int(w): total[at + i] for i, w in enumerate(wanted)}
        at += n
    return out


def fit(df: DataFrame, features: Sequence[str], label: str, cfg: BoostConfig = BoostConfig(), fold: str | None = None,
        row_id: Sequence[str] = ("date",)) -> Boosted:
    """Boosted trees on the rows of ``df`` without NULLs.  ``fold`` (0, 1, ...)
    adds a model for each fold that is fitted on the rows of the others.
    ``row_id`` names the columns that tell rows apart, for the samples."""
    spark = df.sparkSession
    edges = bin_edges(df, features)
    width, k = max([len(e) for e in edges], default=0) + 1, len(features)
    cols = [F.count(label), F.sum(F.col(label).cast("double"))]
    clean = df.dropna(subset=[*features, label, *([fold] if fold else [])])
    by_fold = {r[0]: (r[1], r[2]) for r in clean.groupBy((F.col(fold) if fold else F.lit(-1)).cast("int")).agg(*cols).collect()}
    n, s = (sum(v[i] for v in by_fold.values()) for i in (0, 1))
    base = _blocks(df, features, label, fold, row_id, edges, n)
    start = {-1: s / n if n else 0.0}
    if fold:
        start |= {f: (s - fs) / (n - fn) for f, (fn, fs) in by_fold.items() if n > fn}
    rdd = base.map(lambda b: (*b, {m: b[1] - v for m, v in start.items()})).persist(StorageLevel.MEMORY_AND_DISK)
    trees: dict[int, list[Tree]] = {m: [] for m in start}
    gains: dict[str, float] = {}
    old = None
    for i in range(cfg.trees if n else 0):
        columns = columns_of(i, k, cfg.column_share, cfg.seed)
        growing = {m: _Growing(cfg, columns) for m in start}
        while any(not g.done for g in growing.values()):
            found = _pass(rdd, growing, i, cfg, k, width)
            for m, h in found.items():
                growing[m].learn(h)
        if old is not None:
            old.unpersist()
        new = {m: g.tree for m, g in growing.items()}
        for m, t in new.items():
            trees[m].append(t)
        for f, g in growing[-1].gains.items():
            gains[features[f]] = gains.get(features[f], 0.0) + g
        old = rdd
        rdd = rdd.map(lambda b, new=new: (*b[:4], {m: r - new[m].predict(b[0]) for m, r in b[4].items()})
                      ).persist(StorageLevel.MEMORY_AND_DISK)
        if (i + 1) % CHECKPOINT_TREES == 0:
            rdd.checkpoint()
    for r in (old, rdd):
        if r is not None:
            r.unpersist()
    return Boosted(tuple(features), edges, {m: (start[m], trees[m]) for m in start}, gains)


def predict(model: Boosted, df: DataFrame, out: str = "prediction", fold: str | None = None) -> DataFrame:
    """Rows scored by the model of all rows or, with ``fold``, by the model
    that did not see their fold.  The trees travel with the task (some 3 KB
    each)."""
    n = len(model.features)

    @F.pandas_udf("double")
    def score(f: pd.Series, *xs: pd.Series) -> pd.Series:
        x = np.stack([c.to_numpy(float) for c in xs], 1)
        bins, which = binned(np.nan_to_num(x), model.edges), f.to_numpy()
        y = np.full(len(x), np.nan)
        for m, (start, trees) in model.models.items():
            use = (which == m) & ~np.isnan(x).any(1)
            if use.any():
                y[use] = start + sum((t.predict(bins[use]) for t in trees), np.zeros(use.sum()))
        return pd.Series(y).astype(object).where(~np.isnan(y), None)

    which = F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)
    assert n
    return df.withColumn(out, score(which, *[F.col(c).cast("double") for c in model.features]))
