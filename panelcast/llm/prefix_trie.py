"""Conversation prefix trie from padded turn-id matrices.

Conversations become rows of turn ids (128 bits of role and text), sorted and
dealt by ranges into shards.  A shard's block of rows is a padded matrix: a
numpy lexsort orders it, the OR-accumulated masks of the columns that change
from one row to the next mark where a node begins, and ``reduceat`` over the
cells of all depths gives every node's sums at once.  Nodes that hold a block's
first or last row may go on in the neighbouring blocks: they are written as
partial rows under a hash of their turns and added up by Spark.

All sums are such that they add up over blocks, given how many turns a block's
first row shares with the row before it and its last row with the row after
it: a node begins at the row whose shared depth is smaller than its own, and a
leaf ends at a row that the next row does not extend.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

CYCLE = 9                # of a conversation's crc32: turns taken from its base
FAMILY = 5               # conversations c - c % 5 are bases
BLOCK_CELLS = 1 << 20    # cells of a block's padded matrix; one row may be longer
SHARD_TURNS = 1 << 20    # turns of a range shard, about
ENDS_ROWS = 1 << 16      # ids in one piece of an open node's list of ends
_NONE = hashlib.sha256(b"").hexdigest()

_ROW = ("kind int, shard int, block int, key binary, depth long, parent_key binary, conv_id long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
        "first boolean, last boolean, longer boolean, length long, shared_bytes long, piece int, ids string, "
        "head array<long>, head_bytes array<long>, tail array<long>")
NODE, PARTIAL, ENDS, BLOCK = range(4)


def turns(conversations: DataFrame) -> DataFrame:
    """(c, own): the turns (a, b: hash of role and text, n: bytes of the text)
    of each conversation by number, null first; equal numbers by the hash."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.struct(
            "turn", F.xxhash64(role, text).alias("a"), F.xxhash64(text, F.lit(1), role).alias("b"),
            F.octet_length(text).cast("long").alias("n")).alias("t"))
    return t.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("own"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(c, ids, sizes) of the rebuilt conversations: the first h turns of
    conversation c - c % 5, then c's own after its first h."""
    own = turns(conversations)
    base = own.where(F.col("c") % FAMILY == 0).select(F.col("c").alias("base"), F.slice("own", 1, CYCLE - 1).alias("lead"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % CYCLE).cast("int")
    d = (own.withColumn("h", h).withColumn("base", F.col("c") - F.col("c") % FAMILY).join(base, "base", "left")
         .withColumn("lead", F.coalesce("lead", F.slice("own", 1, 0))))
    whole = F.concat(F.slice("lead", F.lit(1), F.col("h")),
                     F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))))
    d = d.select("c", whole.alias("t"))
    return d.select("c", F.flatten(F.transform("t", lambda x: F.array(x["a"], x["b"]))).alias("ids"), F.col("t.n").alias("sizes"))


def _chain(row: np.ndarray) -> list[bytes]:
    """Keys of the nodes on the path of a row's ids (two for each turn), the
    root first."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    data = row.astype("<i8").tobytes()
    for at in range(0, len(data), 16):
        h.update(data[at:at + 16])
        out.append(h.copy().digest())
    return out


def block_rows(shard: int, block: int, conv: np.ndarray, ids: list[np.ndarray], sizes: list[np.ndarray],
               ends_rows: int = ENDS_ROWS) -> dict[str, list]:
    """Rows of one block: finished nodes, partial nodes, pieces of their lists
    of ends, and the block itself."""
    lens = np.array([len(s) for s in sizes], np.int64)
    n, width = len(conv), int(lens.max(initial=0))
    m = np.full((n, 2 * width), np.iinfo(np.int64).min)     # padding sorts first, as a shorter array does in Spark
    nbytes = np.zeros((n, width + 1), np.int64)            # column d: bytes of turn d; the root has none
    for i, (row, size) in enumerate(zip(ids, sizes, strict=True)):
        m[i, :len(row)] = row
        nbytes[i, 1:len(size) + 1] = size
    order = np.lexsort((conv, lens, *m.T[::-1]))
    m, nbytes, conv, lens = m[order], nbytes[order], conv[order], lens[order]
    upto = np.cumsum(nbytes, axis=1)                       # bytes of the first d turns

    # begins[i, d]: a node of depth d begins at row i; depth 0 is the root.
    changed = (m[1:] != m[:-1]).reshape(n - 1, width, 2).any(axis=2)
    begins = np.ones((n, width + 1), bool)
    begins[1:, 0] = False
    begins[1:, 1:] = np.logical_or.accumulate(changed, axis=1)
    # A row that only goes on where the one before it ended, in padding's place.
    depth = np.arange(width + 1)
    begins[1:] |= (depth > lens[:-1, None]) & (depth <= lens[1:, None])
    valid = depth <= lens[:, None]
    begins &= valid
    shared = lens - begins.sum(axis=1)                     # turns shared with the row before
    shared[0] = -1

    d_of, i_of = np.nonzero(valid.T)                       # cells, depth by depth
    start = np.flatnonzero(begins.T[valid.T])
    node = np.full((width + 1, n), -1, np.int64)
    node[d_of, i_of] = np.cumsum(begins.T[valid.T]) - 1
    first_row, node_depth = i_of[start], d_of[start]
    last_row = i_of[np.append(start[1:], len(i_of)) - 1]
    before = upto[i_of, np.maximum(d_of - 1, 0)] * (d_of > 0)
    upto_shared = np.where(shared >= 0, upto[np.arange(n), np.maximum(shared, 0)], 0)
    saved = np.where(shared[i_of] >= d_of, upto_shared[i_of] - before, 0)
    child = (lens[i_of] > d_of) & (shared[i_of] <= d_of)
    ends_here = np.append(shared[1:] < lens[:-1], False)   # the last row's is left to the block after
    child[i_of == 0] = False                               # and the first row's to the block before

    n_convs = np.diff(np.append(start, len(i_of)))
    least = np.minimum.reduceat(conv[i_of], start)
    saved = np.add.reduceat(saved, start)
    children = np.add.reduceat(child.astype(np.int64), start)
    leaves = np.add.reduceat(ends_here[i_of].astype(np.int64), start)
    parent = np.where(node_depth > 0, node[node_depth - 1, first_row], -1)
    is_first, is_last = first_row == 0, last_row == n - 1
    is_open = is_first | is_last

    # Members that end at a node stand together, with ids rising.
    ended = node[lens, np.arange(n)]
    cuts = np.flatnonzero(np.append(True, ended[1:] != ended[:-1]))
    digests, pieces = {}, []
    for a, e in zip(cuts.tolist(), [*cuts[1:].tolist(), n], strict=True):
        k = int(ended[a])
        if is_open[k]:
            pieces += [(k, p, ",".join(map(str, conv[x:min(e, x + ends_rows)].tolist())))
                       for p, x in enumerate(range(a, e, ends_rows))]
        else:
            digests[k] = hashlib.sha256(",".join(map(str, conv[a:e].tolist())).encode()).hexdigest()

    paths = [_chain(m[i, :2 * lens[i]]) for i in (0, n - 1)]
    def key(k: int) -> bytes | None:
        return paths[0 if is_first[k] else 1][node_depth[k]] if k >= 0 else None

    out: dict[str, list] = {f.split()[0]: [] for f in _ROW.split(", ")}

    def put(**row) -> None:
        for name, values in out.items():
            values.append(row.get(name))

    for k in range(len(start)):
        up, dep = int(parent[k]), int(node_depth[k])
        common = dict(shard=shard, block=block, depth=dep, conv_id=int(least[k]), n_convs=int(n_convs[k]),
                      n_children=int(children[k]), n_leaves=int(leaves[k]), saved_tokens=int(saved[k]))
        if is_open[k]:
            put(kind=PARTIAL, key=key(k), parent_key=key(up), first=bool(is_first[k]), last=bool(is_last[k]),
                longer=bool(is_first[k] and lens[0] > dep), length=int(lens[-1]),
                shared_bytes=int(upto[0, dep - 1]) if dep else 0, **common)
        else:
            up_open = bool(is_open[up])
            put(kind=NODE, parent_key=key(up) if up_open else None, parent_conv_id=None if up_open else int(least[up]),
                ends_sha256=digests.get(k, _NONE), **common)
    for k, p, text in pieces:
        put(kind=ENDS, shard=shard, block=block, key=key(k), piece=p, ids=text)
    put(kind=BLOCK, shard=shard, block=block, head=m[0, :2 * lens[0]].tolist(), head_bytes=upto[0, :lens[0] + 1].tolist(),
        tail=m[-1, :2 * lens[-1]].tolist())
    return out


def _shards(rows: DataFrame, block_cells: int, ends_rows: int) -> DataFrame:
    """All blocks' rows.  The rows lie in ranges of (ids, c), so that equal
    conversations can be split, too."""
    spark = rows.sparkSession
    d = durable(rows, "trie-rebuilt")
    size = d.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_TURNS))
    d = d.repartitionByRange(shards, "ids", "c").sortWithinPartitions("ids", "c").select(
        F.spark_partition_id().alias("shard"), "*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, width, at = [], 0, 0

        def done() -> pa.RecordBatch:
            conv, ids, sizes = zip(*held, strict=True)
            out = block_rows(shard, at, np.array(conv, np.int64), list(ids), list(sizes), ends_rows)
            return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

        for b in batches:
            shard = b.column("shard")[0].as_py() if len(b) else 0
            for c, ids, sizes in zip(b.column("c").to_pylist(), b.column("ids"), b.column("sizes"), strict=True):
                longest = max(width, len(sizes))
                if held and (len(held) + 1) * (longest + 1) > block_cells:
                    yield done()
                    held, at, longest = [], at + 1, len(sizes)
                width = longest
                held.append((c, ids.values.to_numpy(), sizes.values.to_numpy()))
        if held:
            yield done()

    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(spark.createDataFrame([], _ROW).schema)
    return durable(d.mapInArrow(run, _ROW), "trie-blocks")


def _shared_edges(blocks: DataFrame) -> DataFrame:
    """(shard, block, before, before_bytes, after): turns that a block's first
    row shares with the row before it, their bytes, and turns that its last row
    shares with the row after it; -1 at the ends of the table."""
    spark = blocks.sparkSession
    at, starts = 0, []
    for r in sorted(blocks.groupBy("shard").agg(F.count("*").alias("n")).collect()):     # one row for each shard
        starts.append((r["shard"], at))
        at += r["n"]
    offsets = spark.createDataFrame(starts, "shard int, start long")
    b = blocks.join(F.broadcast(offsets), "shard").withColumn("at", F.col("start") + F.col("block"))
    here = b.select("at", "shard", "block", "head", "head_bytes")
    prior = b.select((F.col("at") + 1).alias("at"), "tail", F.col("shard").alias("shard0"), F.col("block").alias("block0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for head, tail, upto in zip(x.column("head"), x.column("tail"), x.column("head_bytes"), strict=True):
                if tail.as_py() is None:
                    out.append((-1, 0))
                    continue
                p, q = head.values.to_numpy(), tail.values.to_numpy()
                m = min(len(p), len(q))
                differ = np.flatnonzero(p[:m] != q[:m])
                turns_ = int(differ[0] if len(differ) else m) // 2
                out.append((turns_, upto.values[turns_].as_py()))
            cols = list(zip(*out, strict=True)) if out else [[], []]
            yield pa.RecordBatch.from_arrays(
                [*(x.column(c) for c in ("shard", "block", "shard0", "block0")), pa.array(cols[0], pa.int64()),
                 pa.array(cols[1], pa.int64())], names=["shard", "block", "shard0", "block0", "before", "before_bytes"])

    edges = durable(here.join(prior, "at", "left").mapInArrow(
        run, "shard int, block int, shard0 int, block0 int, before long, before_bytes long"), "trie-edges")
    after = edges.where("shard0 IS NOT NULL").select(F.col("shard0").alias("shard"), F.col("block0").alias("block"),
                                                     F.col("before").alias("after"))
    return edges.drop("shard0", "block0").join(after, ["shard", "block"], "left").withColumn(
        "after", F.coalesce("after", F.lit(-1).cast("long")))


def _digests(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256) of lists that come in pieces: read in order, so a
    list of any length needs the room of one piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])],
                                              names=["key", "ends_sha256"])
        for b in batches:
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if k != key:
                    if h is not None:
                        yield done()
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
        if h is not None:
            yield done()

    return (pieces.select("key", "shard", "block", "piece", "ids").repartition("key")
            .sortWithinPartitions("key", "shard", "block", "piece").select("key", "ids")
            .mapInArrow(run, "key binary, ends_sha256 string"))


def trie(rows: DataFrame, block_cells: int = BLOCK_CELLS, ends_rows: int = ENDS_ROWS) -> DataFrame:
    """Nodes of the trie of ``rows`` (c: distinct ids, ids: two for each turn,
    sizes: one for each turn); no rows give no nodes."""
    every = _shards(rows, block_cells, ends_rows)
    kind = lambda k: every.where(F.col("kind") == k)
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]

    p = (kind(PARTIAL).select("shard", "block", "key", "depth", "parent_key", "conv_id", *sums, "first", "last", "longer",
                              "length", "shared_bytes").join(_shared_edges(kind(BLOCK)), ["shard", "block"]))
    child = F.when(F.col("longer") & (F.col("before") <= F.col("depth")), 1).otherwise(0)
    leaf = F.when(F.col("last") & (F.col("after") < F.col("length")), 1).otherwise(0)
    extra = F.when(F.col("first") & (F.col("before") >= F.col("depth")), F.col("before_bytes") - F.col("shared_bytes")).otherwise(0)
    p = durable(p.select("shard", "block", "key", "depth", "parent_key", "conv_id", "n_convs",
                         (F.col("n_children") + child).alias("n_children"), (F.col("n_leaves") + leaf).alias("n_leaves"),
                         (F.col("saved_tokens") + extra).alias("saved_tokens")), "trie-partials")
    merged = p.groupBy("key", "depth").agg(F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
                                           *[F.sum(c).alias(c) for c in sums])
    merged = durable(merged, "trie-merged")
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    columns = ["conv_id", "depth", "parent_conv_id", *sums, "ends_sha256"]
    opened = (merged.join(named, "parent_key", "left").withColumn("parent_conv_id", F.col("up"))
              .join(_digests(kind(ENDS)), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE))))
    # A finished node below an open one finds it among its block's own partial rows: no key is hot.
    here = p.select("shard", "block", F.col("key").alias("parent_key")).join(named, "parent_key")
    below = (kind(NODE).where("parent_key IS NOT NULL").join(here, ["shard", "block", "parent_key"])
             .withColumn("parent_conv_id", F.col("up")))
    inner = kind(NODE).where("parent_key IS NULL")
    return opened.select(*columns).unionByName(below.select(*columns)).unionByName(inner.select(*columns))


def prefix_trie(conversations: DataFrame, **options) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of the nodes of the rebuilt conversations.

    conv_id, turn, role and text are used.  Null roles and texts are empty;
    rows without a conv_id belong to no conversation and are left out; turns of
    equal number come in the order of their hashes; repeated rows are repeated
    turns.  An empty table has no nodes.  The ids of one conversation's turns
    (20 bytes each) lie in one row; texts of any length only pass as hashes."""
    return trie(rebuilt(conversations), **options)
