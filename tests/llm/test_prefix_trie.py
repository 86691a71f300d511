import hashlib
import random
import zlib

import pytest

from panelcast.llm import prefix_trie as T

from .edge import rows

SCHEMA = "conv_id long, turn long, role string, text string, depth long, key string, ids int, c int"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations):
    """The contract, node by node.  ``conversations``: {c: [(turn, role, text)]}."""
    own = {c: [(r or "", t or "") for _, r, t in sorted(ts, key=lambda x: (x[0] is not None, x[0] or 0))]
           for c, ts in conversations.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)

    def below(k):
        stack = [k]
        while stack:
            x = stack.pop()
            yield x
            stack += children.get(x, [])
    out = []
    for k, cs in members.items():
        sub = list(below(k))
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(k))))
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), len(children.get(k, [])),
                    sum(x not in children for x in sub),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, conversations):
    data = [(c, t, r, x, 1, "k", 2, 3) for c, ts in conversations.items() for t, r, x in ts]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(4)


def check(spark, conversations, **options):
    got = T.prefix_trie(table(spark, conversations), **options)
    assert got.columns == COLS
    assert rows(got, *COLS) == brute(conversations)


def made(seed, n, long=0, hot=0):
    """Conversations with few distinct turns, so that prefixes are shared;
    some end where others go on; ``hot`` equal ones; ``long`` of many turns."""
    rng = random.Random(seed)
    pick = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["", "a", "ü", "long text " * 9, None]))
    out = {}
    for c in range(n):
        out[c * rng.choice([1, 1, 3])] = [(i, *pick()) for i in range(rng.randint(1, 12))]
    for c in range(long):
        out[10_000 + c] = [(i, *pick()) for i in range(rng.randint(60, 150))]
    same = [(i, "user", f"t{i}") for i in range(14)]
    for c in range(hot):
        out[20_000 + 5 * c] = list(same)
    return out


@pytest.mark.parametrize("cells", [1 << 20, 60, 1])
def test_blocks_of_any_size(spark, cells):
    """One block, small blocks and blocks of a single row give the same."""
    check(spark, made(cells, 120, long=3, hot=40), block_cells=cells, ends_rows=3)


def test_edges(spark):
    d = {0: [(None, None, None), (1, "user", "x")], 1: [(0, "user", "x")], 2: [(-1, "user", "x"), (0, "user", "")],
         7: [(0, "a", "b")], 8: [(0, "a", "b")], 4: [(i, "u", str(i)) for i in range(30)], 3: [(i, "u", str(i)) for i in range(30)]}
    check(spark, d)
    check(spark, {5: [(0, "u", "only")]})
    assert T.prefix_trie(table(spark, {})).collect() == []


def test_no_conversation_id_and_repeated_rows(spark):
    d = spark.createDataFrame([(None, 0, "u", "x"), (5, 0, "u", "x"), (5, 0, "u", "x"), (5, 1, "u", "y")],
                              "conv_id long, turn long, role string, text string")
    assert rows(T.prefix_trie(d), *COLS) == brute({5: [(0, "u", "x"), (0, "u", "x"), (1, "u", "y")]})


def test_single_block_without_spark():
    """A prefix that ends in one row and goes on in the next, and padding that looks like an id."""
    import numpy as np
    ids = [np.array([1, 1]), np.array([1, 1, 0, 0]), np.array([1, 1, 0, 0]), np.array([], np.int64)]
    sizes = [np.array([4]), np.array([4, 2]), np.array([4, 2]), np.array([], np.int64)]
    out = T.block_rows(0, 0, np.array([3, 1, 2, 9]), ids, sizes)
    n = [i for i, k in enumerate(out["kind"]) if k in (T.NODE, T.PARTIAL)]
    got = sorted((out["depth"][i], out["conv_id"][i], out["n_convs"][i]) for i in n)
    assert got == [(0, 1, 4), (1, 1, 3), (2, 1, 2)]
