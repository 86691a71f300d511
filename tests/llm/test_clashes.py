"""Documents with columns named as the operators' own."""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402

import corpus_pipeline  # noqa: E402
from panelcast.llm import pii, repeats  # noqa: E402
from panelcast.llm.common import quoted  # noqa: E402

NAMES = ["_rid", "_base", "_spans", "_new", "_mentions", "_want", "_rest", "rid", "m", "d1", "s", "n", "c", "a", "b",
         "_host", "_w", "_l", "part", "x y", "z.w"]


def _odd(spark):
    d = edge.documents(spark)
    for i, name in enumerate(NAMES):
        d = d.withColumn(name, F.lit(f"v{i}") if i % 2 else F.array(F.lit(i)))
    return d


def _values(df):
    return sorted(repr([r[c] for c in df.columns if c not in ("text", "n_chars", "_base", "_spans")]) for r in df.collect())


def test_operators(spark):
    d = _odd(spark)
    for out in (repeats.remove(d), pii.redact(d)):
        assert out.columns == d.columns and _values(out) == _values(d)
    for out in (repeats.find(d), pii.extract(d)):
        assert sorted(out.columns) == sorted(d.columns) and _values(out.select(*map(quoted, d.columns))) == _values(d)


def test_stages(spark, tmp_path):
    d = _odd(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, str(tmp_path))
        assert out.columns == d.columns and set(_values(out)) <= set(_values(d))
