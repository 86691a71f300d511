"""Language-model scores against a plain dictionary model."""

import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from panelcast.llm import lm  # noqa: E402


def _tokens(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]


def _brute(rows):
    c1, c2, begins = Counter(), Counter(), 0
    for _, text, train in rows:
        if train:
            t = _tokens(text)
            c1.update(t)
            c2.update(zip(["<s>", *t[:-1]], t, strict=True))
            begins += 1
    n, v = sum(c1.values()), len(c1)
    out = []
    for doc, text, train in rows:
        t = _tokens(text)
        base = score = 0.0
        for u, w in zip(["<s>", *t[:-1]], t, strict=True):
            p = (c1[w] + .5) / (n + .5 * (v + 1))
            c = begins if u == "<s>" else c1[u]
            k = lm.KAPPA + lm.ALPHA * c
            base += math.log10(p)
            score += math.log10((c2[u, w] + k * p) / (c + k))
        out.append((doc, bool(train), len(t), sum(c1[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in df.collect()), key=repr)


def test_scores_equal_a_dictionary_model(spark):
    docs = edge.documents(spark).withColumn("train", F.coalesce(F.col("doc_id") % 5 != 1, F.lit(True)))
    rows = [(r.doc_id, r.text, r.train) for r in docs.collect()]
    for block_bytes in (lm.BLOCK_BYTES, 3000):
        assert _got(lm.score(docs, block_bytes)) == _brute(rows)


def test_repeated_text_and_no_training(spark):
    rng = random.Random(1)
    base = edge.words(rng, 700)
    rows = [(i, base if i % 2 else edge.words(rng, 30), i % 3 != 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    assert _got(lm.score(docs, 5000)) == _brute(rows)
    none = docs.withColumn("train", F.lit(None).cast("boolean"))
    assert _got(lm.score(none)) == _brute([(a, b, False) for a, b, _ in rows])
    assert lm.score(docs.limit(0)).count() == 0


def test_probabilities_after_each_state_sum_to_one():
    text = "a b a c a b d".split()
    codes = {w: i for i, w in enumerate(sorted(set(text)))}
    hashes = np.sort(np.array([10, 20, 30, 40], np.uint64))
    block = lm.Block([True], [len(text)], lm._pack(hashes), lm._pack(np.array([codes[w] for w in text], np.uint32)))
    counts = {k: block.counts[k].astype(float) for k in (1, 2)}
    m = lm.Automaton(block, counts, len(text) + 1, len(codes) + 1)
    unknown = 0.5 / (len(text) + 1 + 0.5 * (len(codes) + 2))
    for state in range(1, block.n + 1):
        weights, _ = m.read(np.full(block.n + 1, state), np.arange(block.n + 1))
        assert abs((10 ** weights).sum() + unknown * 10 ** m.fail[state] - 1) < 1e-9


def _chances(rows, order):
    """Scores by the recursive formula over dictionaries."""
    counts, n_total = Counter(), 0
    for _, text, train in rows:
        if train:
            t = ["<s>", *_tokens(text)]
            n_total += len(t) - 1
            counts[("<s>",)] += 1
            for i in range(1, len(t)):
                counts.update(tuple(t[i - k + 1:i + 1]) for k in range(1, order + 1) if i - k + 1 >= 0)
    v = sum(len(g) == 1 for g in counts) - (("<s>",) in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + .5) / (n_total + .5 * (v + 1))
        c = counts[gram[:-1]]
        k = lm.KAPPA + lm.ALPHA * c
        return (counts[gram] + k * p(gram[1:])) / (c + k)

    out = []
    for doc, text, train in rows:
        t = ["<s>", *_tokens(text)]
        out.append((doc, bool(train), round(sum(math.log10(p(tuple(t[max(0, i - order + 1):i + 1])))
                                                for i in range(1, len(t))), 6)))
    return sorted(out, key=repr)


def _scored(df):
    return sorted(((r.doc_id, r.train, round(r.score, 6)) for r in df.collect()), key=repr)


def _chained(rng, n):
    """Texts with runs that come again, so that long histories are seen, and long ones read in pieces."""
    runs = [edge.words(rng, 12) for _ in range(6)]
    return [" ".join(rng.choice(runs) if rng.random() < .7 else edge.words(rng, 3) for _ in range(rng.randint(1, 60)))
            for _ in range(n)]


def test_orders_equal_the_recursive_formula(spark):
    rng = random.Random(3)
    rows = [(i, t, i % 4 != 0) for i, t in enumerate([*_chained(rng, 40), "", None, "Once"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
    for order in (1, 2, 3, 4):
        assert _scored(lm.score(docs, 20000, order=order)) == _chances(rows, order)


def test_levels_of_shards_give_the_same_scores(spark):
    rng = random.Random(4)
    rows = [(i, t, i % 4 != 0) for i, t in enumerate(_chained(rng, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(2)
    got = lm.score(docs, 1500, order=3, fan_bits=2)              # some 40 blocks, three levels
    assert _scored(got) == _chances(rows, 3)
    one = {r.doc_id: (r.n_known, r.train_tokens, r.base_score) for r in lm.score(docs, order=3).collect()}
    for r in got.collect():
        assert (r.n_known, r.train_tokens) == one[r.doc_id][:2] and abs(r.base_score - one[r.doc_id][2]) < 1e-6


def test_a_sender_has_a_bounded_number_of_shards(spark):
    rng = random.Random(5)
    rows = [(i, t, True) for i, t in enumerate(_chained(rng, 120))]
    for n in (60, 120):
        docs = spark.createDataFrame(rows[:n], "doc_id long, text string, train boolean").repartition(2)
        packed = lm.blocks(docs, 1500)
        sent = lm._requests(packed, 2, 3).count()
        assert sent <= packed.count() * 3 * 4                    # orders, shards
