"""Repeated substrings against brute force."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402

from panelcast.llm import repeats  # noqa: E402


def _brute(texts, span):
    data = [(t or "").encode() for t in texts]
    count = Counter(x[i:i + span] for x in data for i in range(len(x) - span + 1))
    out = []
    for x in data:
        hit = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - span + 1):
            if count[x[i:i + span]] > 1:
                hit[i:i + span] = True
        edges = np.count_nonzero(hit[1:] & ~hit[:-1]) + bool(hit[0])
        out.append((len(x), int(hit.sum()), int(edges), hashlib.sha256(bytes(np.frombuffer(x, np.uint8)[~hit[:-1]])).hexdigest()))
    return out


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)


def _planted(rng):
    w = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, block = w(700), w(1500)
    texts = [w(rng.randint(0, 900)) for _ in range(20)] + [None, "", "é" * 900, "ab" * 3000, "x" * 399, "y" * 400, "y" * 400]
    texts += [w(300) + passage + w(300) for _ in range(5)] + [passage[:399], passage[100:520]]
    for _ in range(8):                               # near copies
        c = list(block)
        for _ in range(2):
            c[rng.randrange(len(c))] = "Z"
        texts.append("".join(c))
    return texts + [block + "tail" + block, block, block]


@pytest.mark.parametrize("hot_bytes", [repeats.HOT_BYTES, 2000])
def test_repeats_equal_brute_force(spark, hot_bytes):
    texts = _planted(random.Random(6))
    got = repeats.report(_docs(spark, texts), hot_bytes=hot_bytes).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == _brute(texts, 400)


def test_repeats_small_spans(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(60)]
    got = repeats.report(_docs(spark, texts), span=24, gram=8).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == _brute(texts, 24)


def test_repeats_edge_cases(spark):
    docs = edge.documents(spark)
    rows = docs.collect()
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, _brute([r.text for r in rows], 400), strict=True)), key=repr)
    assert edge.rows(repeats.report(docs)) == want
    assert repeats.report(edge.empty(spark)).count() == 0
    cut = repeats.remove(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)


def test_suffix_array_and_runs():
    rng = np.random.default_rng(0)
    for size, letters in [(1, 2), (5, 2), (9, 3), (200, 2), (3000, 4)]:
        t = rng.integers(0, letters, size, dtype=np.uint8)
        want = sorted(range(size), key=lambda i: t[i:].tobytes())
        assert repeats.suffix_array(t).tolist() == want
    t = np.frombuffer(b"abracadabra" * 40, np.uint8)
    assert repeats.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tobytes())
    index = repeats.RunIndex(t)
    assert index.lengths.sum() == len(t) and len(index.heads) < len(t) / 10


def _brute_passages(texts, passage):
    """(n_passages, passage_bytes) of each text."""
    data = [(t or "").encode() for t in texts]
    span = passage["span"]
    count = Counter(x[i:i + span] for x in data for i in range(len(x) - span + 1))
    out = []
    for x in data:
        runs = []
        for i in range(len(x) - span + 1):
            if count[x[i:i + span]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + span
                else:
                    runs.append([i, i + span])
        runs = [(a, b) for a, b in runs if b - a >= passage["any_bytes"] or len(x[a:b].split()) >= passage["min_words"]]
        out.append((len(runs), sum(b - a for a, b in runs)))
    return out


def test_query_finds_passages_shorter_than_its_strings(spark, tmp_path):
    """Shared passages of 51 to 60 words, some of fewer than 400 bytes, are
    counted; what is removed stays with strings of 400 bytes."""
    from panelcast.llm import queries
    rng = random.Random(8)
    word = lambda least, most: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(least, most)))
    words = lambda n, least=2, most=7: " ".join(word(least, most) for _ in range(n))
    texts = [words(rng.randint(60, 300)) for _ in range(20)] + [None, "", "é" * 900]
    planted = len(texts)
    for shared in (words(51, 5, 6), words(55, 5, 5), words(60), words(120)):
        texts += [words(80) + " " + shared + " " + words(70) for _ in range(3)]
    short = len(texts)
    texts += [words(80) + " " + shared + " " + words(70) for shared in [words(30)] for _ in range(3)]
    texts += [texts[0], texts[1] + " tail"]
    _docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op1_repeats(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [x + y for x, y in zip(
        _brute(texts, 400), _brute_passages(texts, repeats.PASSAGE), strict=True)]
    assert all(r.n_passages == 1 for r in got[planted:short])
    assert any(r.n_removed == 0 for r in got[planted:short])
    assert not any(r.n_passages for r in got[short:-2])


@pytest.mark.parametrize("hot_bytes", [repeats.HOT_BYTES, 2000])
def test_passages_equal_brute_force(spark, hot_bytes):
    texts = _planted(random.Random(9))
    passage = {"span": 100, "gram": 16, "min_words": 12, "any_bytes": 150}
    got = repeats.report(_docs(spark, texts), hot_bytes=hot_bytes, passage=passage).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [x + y for x, y in zip(
        _brute(texts, 400), _brute_passages(texts, passage), strict=True)]


def test_passages_edge_cases(spark, monkeypatch):
    docs = edge.documents(spark)
    rows = docs.collect()
    texts = [r.text for r in rows]
    both = zip(rows, _brute(texts, 400), _brute_passages(texts, repeats.PASSAGE), strict=True)
    want = sorted(((r.doc_id, *x, *y) for r, x, y in both), key=repr)
    assert edge.rows(repeats.report(docs, passage=repeats.PASSAGE)) == want
    assert repeats.report(edge.empty(spark), passage=repeats.PASSAGE).count() == 0
    monkeypatch.setattr("panelcast.llm.common.MAX_BITMAPS", 0)           # joins instead of bitmaps
    assert edge.rows(repeats.report(docs, passage=repeats.PASSAGE)) == want


def test_passages_small_spans(spark):
    rng = random.Random(10)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 120))) for _ in range(60)]
    passage = {"span": 12, "gram": 8, "min_words": 3, "any_bytes": 20}
    got = repeats.report(_docs(spark, texts), span=16, gram=8, passage=passage).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == [x + y for x, y in zip(
        _brute(texts, 16), _brute_passages(texts, passage), strict=True)]
