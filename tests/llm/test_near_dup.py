"""Near duplicates against brute force."""

import os
import random
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402

from panelcast.llm import near_dup  # noqa: E402


def _set(text, k):
    w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def _brute(rows, k):
    sets = [_set(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted(((d, len(s), low.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def _near(rng, words, share):
    return " ".join(w if rng.random() > share else "new" + str(rng.randrange(10**6)) for w in words)


@pytest.mark.parametrize("words", [2, 5])
def test_components_equal_brute_force(spark, words):
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = edge.words(rng, rng.choice([5, 30, 200, 400])).split()
        for _ in range(rng.choice([2, 5, 25])):
            rows.append((len(rows) * 7 % 1000, _near(rng, base, rng.choice([0, .01, .03, .06, .1]))))
    chain = edge.words(rng, 300).split()
    for _ in range(12):                      # each is like the next, the ends are not alike
        rows.append((1000 + len(rows), " ".join(chain)))
        for i in rng.sample(range(300), 9):
            chain[i] = "w%d" % rng.randrange(10**6)
    rows += [(2000, "one"), (2001, "ONE"), (2002, "one two"), (2003, "one two"), (2004, None), (2005, ""), (2006, " \n"),
             (2007, "É a"), (2008, "é a"), (2003, "one two"), (None, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = near_dup.near_duplicates(docs, words=words)
    assert edge.rows(out, "doc_id", "n_shingles", "component_id") == _brute(rows, words)
    got = out.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    first = [r for r in got if r.n_shingles and r["first"]]
    assert len({r.component_id for r in first}) == len(first)


def test_near_edge_cases(spark):
    docs = edge.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert edge.rows(near_dup.near_duplicates(docs, words=2), "doc_id", "n_shingles", "component_id") == _brute(rows, 2)
    assert near_dup.near_duplicates(edge.empty(spark)).count() == 0
    left = near_dup.deduplicate(docs)
    assert left.columns == docs.columns
    assert left.count() == near_dup.near_duplicates(docs).where("first").count() < len(rows)


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 1500).astype(np.uint64)
    a, b = near_dup.signature(np.unique(x[:1200]), 256), near_dup.signature(np.unique(x[300:]), 256)
    assert abs((a == b).mean() - 0.6) < 0.08 and abs((a == b)[:, 0].mean() - 0.6) < 0.1


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(500, 900), (700, 900), (500, 500)], "a long, b long")
    got = {r.node: r.label for r in near_dup.components(links.where("a <> b")).collect()}
    assert got == {i: 0 for i in range(301)} | {500: 500, 700: 500, 900: 500}


def test_rows_of_given_ids_by_bitmaps_and_by_join(spark, monkeypatch):
    rng = random.Random(5)
    every = [p << 33 | n for p in (0, 1, 7) for n in range(0, 70000, 7)] + [0, 1, 32767, 32768, 32769]
    wanted = rng.sample(every, 900) + [0, 32768]
    rows = spark.createDataFrame([(x,) for x in every], "rid long").distinct()
    ids = spark.createDataFrame([(x,) for x in wanted * 2], "id long")
    for most in (near_dup.MAX_BITMAPS, 1):
        monkeypatch.setattr(near_dup, "MAX_BITMAPS", most)
        assert sorted(r.rid for r in near_dup._having(rows, "rid", ids, "id").collect()) == sorted(set(wanted))
    assert near_dup._having(rows, "rid", ids.limit(0), "id").count() == 0


def test_signatures_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    least = near_dup.least_equal(2 * near_dup.PERMUTATIONS)
    assert 70 < least < 80
    for size in (1, 4, 8, 40, 400):
        for _ in range(60):
            both = rng.integers(0, 1 << 62, size * 10, dtype=np.int64).astype(np.uint64)
            a, b = (near_dup.short(near_dup.signature(np.concatenate([both[:8 * size], x])))
                    for x in (both[8 * size:9 * size], both[9 * size:]))      # 8 of 10 shingles
            assert (a == b).sum() >= least
    assert list(near_dup._signed(near_dup.band_keys(a)) % near_dup.NUMBERS) == list(range(32))


def test_members_of_a_large_component_do_not_meet_each_other_again(spark, monkeypatch):
    """Rows of a bucket grow with its largest component, not with its square."""
    class Seen(Exception):
        pass

    def durable(df, name):
        assert name == "near-rest"
        raise Seen(df.collect())

    monkeypatch.setattr(near_dup, "durable", durable)
    monkeypatch.setattr(near_dup, "BLOCK", 10)
    members = spark.range(43).selectExpr("7L as band", "id")
    labels = spark.createDataFrame([(i, 0) for i in range(40)], "node long, label long")
    with pytest.raises(Seen) as e:
        near_dup._rest(members, labels, None, 80, 4)
    rows = e.value.args[0]
    assert len(rows) <= 40 + 3 * 6                                  # 215 when all blocks met all
    places = {}
    for r in rows:
        places.setdefault((r.i, r.j), []).append((r.second, r.id, r.label))
    met = set()
    for (i, j), group in places.items():
        for a in group:
            for b in group:
                if a[1] < b[1] and a[2] != b[2] and (i == j or a[0] != b[0]):
                    assert (a[1], b[1]) not in met
                    met.add((a[1], b[1]))
    assert met == {(a, b) for b in range(40, 43) for a in range(b)}
