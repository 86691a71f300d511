"""Near-duplicate documents by min-max hashing.

A document's shingles are hashed under a number of permutations, and both the
minimum and the maximum of each are kept: two signature values for one hash
evaluation.  Bands of four values make buckets.  Documents of equal sets are
one class before anything is paired; within a bucket a class is first
compared with the smallest class only, and other pairs are compared only where
their classes are not connected yet, so a large group of near copies costs
about one comparison for each member and bucket.  Every link is confirmed on
the full sets, but sizes and signatures are tested before any set moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import bundled, durable, unbundled

WORDS = 2                # words of a shingle in op8's contract; the library's default is DEFAULT_WORDS
DEFAULT_WORDS = 5
PERCENT = 80             # 100 * intersection >= PERCENT * union
PERMUTATIONS = 64        # two signature values each
ROWS = 4                 # values in a band: 32 bands miss a pair of similarity 0.8 once in 20 million
CENTER_ROWS = 2000       # sets compared with one center in one group
BLOCK = 1000             # members of a bucket that are compared with as many others in one group
SIGMAS = 6               # a pair whose signatures lie that far below the threshold is not looked at further
NUMBERS = 1024           # bands at most
MAX_BITMAPS = 8192       # of 4 KB for 32,768 rows each: what a filter on row ids may broadcast

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_rng = np.random.default_rng(8)
_FACTORS = (_rng.integers(0, 1 << 63, 512, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_MASKS = _rng.integers(0, 1 << 63, 512, dtype=np.int64).astype(np.uint64)


def _mix(x):
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of the text's shingles, ascending: A-Z in lower
    case, words between ASCII white space; a text with fewer words is one."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = min(words, len(w))
    s = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        s = _mix(s + h[i:len(h) - n + 1 + i])
    return np.unique(s)


def signature(s: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """(permutations, 2): minimum and maximum of the set under each."""
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    f, m = _FACTORS[:permutations, None], _MASKS[:permutations, None]
    for at in range(0, len(s), 2048):
        x = (s[None, at:at + 2048] ^ m) * f
        np.minimum(low, x.min(1), out=low)
        np.maximum(high, x.max(1), out=high)
    return np.stack([low, high], 1)


def short(sig: np.ndarray) -> np.ndarray:
    """16 bits of each signature value: equal values stay equal, others become
    equal once in 65,536."""
    return (_mix(sig.ravel()) & np.uint64(0xFFFF)).astype(np.uint16)


def least_equal(values: int, percent: int = PERCENT) -> int:
    """Signature values that a pair at the threshold has in common, less SIGMAS
    deviations: fewer come once in some 500 million pairs.  Minimum and maximum
    of a permutation don't differ together more often than independent ones."""
    p = percent / 100
    return max(0, int(np.floor(values * p - SIGMAS * np.sqrt(values * p * (1 - p)))))


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key for each band of ``rows`` signature values; its low bits are the
    band's number."""
    flat = sig.ravel().astype(np.uint64)
    bands = flat[:len(flat) // rows * rows].reshape(-1, rows)
    number = np.arange(len(bands), dtype=np.uint64)
    key = number.copy()
    for i in range(rows):
        key = _mix(key * _M2 + bands[:, i])
    return key & ~np.uint64(NUMBERS - 1) | number


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sketch(docs: DataFrame, words: int, permutations: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, f1, f2, bands, sigs = [], [], [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t, words)
                n.append(len(s))
                mixed = _mix(s ^ _M1)
                f1.append(int(_signed(np.array([s.sum(dtype=np.uint64)]))[0]))
                f2.append(int(_signed(np.array([np.bitwise_xor.reduce(mixed) if len(s) else 0], np.uint64))[0]))
                sig = short(signature(s, permutations))
                bands.append(_signed(band_keys(sig, rows)) if len(s) else [])
                sigs.append(sig.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                names=[*b.schema.names, "n_shingles", "f1", "f2", "bands", "sig"])

    d = docs.select(F.monotonically_increasing_id().alias("rid"), "*")
    schema = StructType([*d.schema.fields, *(StructField(c, LongType()) for c in ("n_shingles", "f1", "f2")),
                         StructField("bands", ArrayType(LongType())), StructField("sig", BinaryType())])
    return d.mapInArrow(run, schema)


def _having(rows: DataFrame, col: str, ids: DataFrame, other: str) -> DataFrame:
    """The ``rows`` whose ``col`` is one of ``ids``: by broadcast bitmaps, so
    that the rows need not move, while there are at most MAX_BITMAPS of them;
    by a shuffled join beyond."""
    # Ids move before they are added up: each task would have a bitmap for each bucket.
    ids = ids.select(other, F.bitmap_bucket_number(other).alias("_bucket"))
    bits = durable(ids.repartition("_bucket").groupBy("_bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(other)).alias("_bits")), "near-bits")
    if bits.count() > MAX_BITMAPS:
        return rows.join(ids.select(F.col(other).alias(col)).distinct(), col, "left_semi")
    at = F.bitmap_bit_position(col)
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(bitmap_bit_position({col}) div 8 as int) + 1, 1)")), 16, 10)
    return (rows.withColumn("_bucket", F.bitmap_bucket_number(col)).join(F.broadcast(bits), "_bucket")
            .where(byte.cast("int").bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0)
            .drop("_bucket", "_bits"))


def _sets(d: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("n"), b.column("sig"),
                 pa.array([shingles(t, words).tobytes() for t in b.column("text").to_pylist()], pa.binary())],
                names=["rid", "n", "sig", "data"])

    return d.select("rid", F.col("n_shingles").alias("n"), "sig", "text").mapInArrow(
        run, "rid long, n long, sig binary, data binary")


def likely(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that sizes and signatures don't rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.array([np.frombuffer(v.as_buffer(), np.uint16) for v in b.column(c)]).reshape(b.num_rows, -1)
                    for c in ("x", "y"))
            ok = (x == y).sum(1) >= least_equal(x.shape[1], percent)
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    own = sets.select("rid", "n", "sig")
    both = (pairs.join(own.toDF("a", "n", "x"), "a").join(own.toDF("b", "m", "y"), "b")
            .where(100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets are similar.  A center's members come in
    groups of bounded size, each with a copy of the center's set."""
    pairs = durable(likely(pairs, sets, percent), "near-likely")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    sets = _having(sets.select("rid", "data"), "rid", ids, "id")
    sizes = pairs.groupBy("a").agg(F.count("*").alias("c")).select(
        "a", F.ceil(F.col("c") / CENTER_ROWS).cast("int").alias("k"))
    member = (pairs.join(sizes, "a").join(sets.withColumnRenamed("rid", "b"), "b")
              .select("a", F.pmod(F.xxhash64("b"), F.col("k").cast("long")).cast("int").alias("salt"), "b", "data"))
    center = (sizes.join(sets.withColumnRenamed("rid", "a"), "a")
              .select("a", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("salt"),
                      F.lit(None).cast("long").alias("b"), "data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            out_a, out_b = [], []
            for a, b, data in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(),
                                  batch.column("data"), strict=True):
                s = np.frombuffer(data.as_buffer(), np.uint64)
                if b is None:
                    own = s
                    continue
                small, large = (own, s) if len(own) < len(s) else (s, own)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.searchsorted(large, small)
                common = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
                if 100 * common >= percent * (len(small) + len(large) - common):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    rows = member.unionByName(center).repartition("a", "salt").sortWithinPartitions(
        "a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of linked nodes, label the smallest node reachable: by
    alternating large stars and small stars until the links form stars."""
    e = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-links")
    state = None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = durable(small, "near-stars")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        state = now


def _labelled(rows: DataFrame, labels: DataFrame | None, col: str, name: str) -> DataFrame:
    if labels is None:
        return rows.withColumn(name, F.col(col))
    own = labels.select(F.col("node").alias(col), F.col("label").alias("_label"))
    return rows.join(own, col, "left").withColumn(name, F.coalesce("_label", col)).drop("_label")


def _rest(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """Links (a, b) between the components that still share a bucket; of the
    links that join the same components not all are returned.

    A bucket's members are compared in blocks inside the tasks, so pairs never
    become rows: first by size and signature, then, for members that have a
    likely partner in the same two blocks, by their sets."""
    m = _labelled(members, labels, "id", "label")
    parts = m.groupBy("band", "label").agg(F.count("*").alias("s"))
    sizes = parts.groupBy("band").agg(F.sum("s").alias("c"), F.max(F.struct("s", "label")).alias("big"), F.count("*").alias("n"))
    # The largest component's members only meet the others: it has blocks of its own, from number k on.
    apart = F.col("c") > BLOCK
    own = F.when(apart, F.ceil(F.col("big.s") / BLOCK)).otherwise(0).cast("int")
    others = F.when(apart, F.ceil((F.col("c") - F.col("big.s")) / BLOCK)).otherwise(1).cast("int")
    m = m.join(sizes.where("n > 1").select("band", own.alias("own"), others.alias("k"), F.col("big.label").alias("large")), "band")
    m = m.withColumn("large", (F.col("own") > 0) & (F.col("label") == F.col("large")))
    dealt = F.when(F.col("large"), F.col("own")).otherwise(F.col("k")).cast("long")
    m = m.withColumn("block", F.pmod(F.xxhash64("id"), dealt).cast("int") + F.when(F.col("large"), F.col("k")).otherwise(0))
    # Block x meets blocks x, ... as the first and 0, ..., x-1 as the second of a pair of blocks.
    m = m.withColumn("other", F.explode(F.sequence(
        F.lit(0), F.when(F.col("large"), F.col("k")).otherwise(F.col("k") + F.col("own")) - 1))).select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).alias("second"), "id", "label")
    m = durable(m, "near-rest")

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
        """(key, rows) of each pair of blocks."""
        group, key = [], None
        for b in batches:
            for r in b.to_pylist():
                k = (r["band"], r["i"], r["j"])
                if k != key:
                    if group:
                        yield key, group
                    group, key = [], k
                group.append(r)
        if group:
            yield key, group

    def batched(found: Iterator[list[tuple]], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array([r[x] for r in out], t) for x, t in enumerate(kinds)], names=names)

        out = []
        for part in found:
            out += part
            if len(out) >= 4096:
                yield batch(out)
                out = []
        yield batch(out)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["band", "i", "j", "second", "id", "label"]
        found = ([tuple(group[x][c] for c in names) for x in _partnered(group, key, percent, rows)]
                 for key, group in grouped(batches))
        return batched(found, names, [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (_compare([(r["second"], r["id"], r["label"], r["n"], np.frombuffer(r["data"], np.uint64)) for r in group],
                          key, percent) for key, group in grouped(batches))
        return batched(found, ["a", "b"], [pa.int64(), pa.int64()])

    def blocks(m: DataFrame, *cols: str) -> DataFrame:
        # A member meets its set once, and then goes to all its places.
        own = _having(sets.select("rid", *cols), "rid", m, "id").withColumnRenamed("rid", "id")
        places = m.groupBy("id", "label").agg(F.collect_list(F.struct("band", "i", "j", "second")).alias("_places"))
        m = places.join(own, "id").select(F.explode("_places").alias("_place"), "id", "label", *cols).select(
            "_place.*", "id", "label", *cols)
        return m.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "second", "id")

    m = durable(blocks(m, "n", "sig").mapInArrow(mark, "band long, i int, j int, second boolean, id long, label long"),
                "near-partnered")
    return blocks(m, "n", "data").mapInArrow(run, "a long, b long")


def _partnered(group: list[dict], key: tuple, percent: int, rows: int) -> list[int]:
    """Places of the members with a partner of another component that size and
    signature don't rule out.  A pair counts in the first of its common bands."""
    one_block = key[1] == key[2]
    second, n = np.array([g["second"] for g in group]), np.array([g["n"] for g in group])
    label = np.array([g["label"] for g in group])
    sig = np.stack([np.frombuffer(g["sig"], np.uint16) for g in group])
    bands = sig[:, :sig.shape[1] // rows * rows].reshape(len(group), -1, rows)
    least, found = least_equal(sig.shape[1], percent), np.zeros(len(group), bool)
    for x in range(len(group)) if one_block else np.flatnonzero(~second).tolist():
        others = np.arange(x + 1, len(group)) if one_block else np.flatnonzero(second)
        ok = (label[others] != label[x]) & (
            100 * np.minimum(n[x], n[others]) >= percent * np.maximum(n[x], n[others]))
        others = others[ok]
        others = others[(sig[others] == sig[x]).sum(1) >= least]
        if len(others):
            equal = (bands[others] == bands[x]).all(2)
            others = others[equal.argmax(1) == key[0] % NUMBERS]
        found[others] = True
        found[x] |= len(others) > 0
    return np.flatnonzero(found).tolist()


def _compare(group: list[tuple], key: tuple, percent: int) -> list[tuple[int, int]]:
    """Links between members of two blocks (or of one) in different components,
    one for each two components that they join."""
    one_block = key[1] == key[2]
    second, ids = np.array([g[0] for g in group]), np.array([g[1] for g in group])
    n = np.array([g[3] for g in group])
    size = np.array([len(g[4]) for g in group])
    _, label = np.unique([g[2] for g in group], return_inverse=True)
    at = np.concatenate([[0], np.cumsum(size)])
    tokens = np.concatenate([g[4] for g in group])
    links = []
    for x in range(len(group)) if one_block else np.flatnonzero(~second).tolist():
        others = np.arange(x + 1, len(group)) if one_block else np.flatnonzero(second)
        most = np.minimum(size[x], size[others])
        ok = (label[others] != label[x]) & (100 * most >= percent * (n[x] + n[others] - most))
        others = others[ok]
        if not len(others):
            continue
        # One other member of a component at first: most often it is linked, and the rest need no look.
        _, first = np.unique(label[others], return_index=True)
        for part in (others[first], np.delete(others, first)):
            part = part[label[part] != label[x]]
            if not len(part):
                continue
            start = np.concatenate([[0], np.cumsum(size[part])])
            every = tokens[np.repeat(at[part] - start[:-1], size[part]) + np.arange(start[-1])]
            own = group[x][4]
            hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            common = np.add.reduceat(hit.astype(np.int64), start[:-1])
            for y in part[100 * common >= percent * (n[x] + n[part] - common)].tolist():
                if label[y] != label[x]:
                    links.append((int(ids[x]), int(ids[y])))
                    label[label == label[y]] = label[x]
    return links


def near_duplicates(docs: DataFrame, words: int = DEFAULT_WORDS, percent: int = PERCENT,
                    permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, kept, first) of each row.

    component_id is the smallest doc_id reachable over links (null is larger
    than any), kept whether that is the row's own; ``first`` marks one row of
    each component, also among repeated rows.  Null texts and texts without
    words have empty sets and are linked with nothing."""
    return _search(docs.select("doc_id", "text"), words, percent, permutations, rows)[1]


def _search(docs: DataFrame, words: int = DEFAULT_WORDS, percent: int = PERCENT, permutations: int = PERMUTATIONS,
            rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with their rid, and the result by rid."""
    d = durable(_sketch(docs, words, permutations, rows), "near-docs")
    some = d.where("n_shingles > 0")
    same = ["f1", "f2", "n_shingles"]
    one = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    classes = durable(some.groupBy(*same).agg(F.min(one).alias("one"), F.min("rid").alias("node")), "near-classes")
    members = durable(_having(some.select("rid", "bands"), "rid", classes, "node")
                      .select(F.explode("bands").alias("band"), F.col("rid").alias("id")), "near-bands")
    lowest = members.groupBy("band").agg(F.min("id").alias("a"), F.count("*").alias("c")).where("c > 1").select("band", "a")
    # Members of buckets that hold more than one class; the rest is done.
    members = durable(members.join(lowest, "band"), "near-members")
    stars = durable(members.where("a <> id").select("a", F.col("id").alias("b")).distinct(), "near-pairs")
    involved = stars.select(F.col("a").alias("id")).unionByName(stars.select(F.col("b").alias("id")))
    sets = durable(_sets(_having(d, "rid", involved, "id"), words), "near-sets")

    # First each class with the smallest of all its buckets, ...
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = durable(confirm(first, sets, percent), "near-found")
    labels = durable(components(links), "near-labels")
    # ... then with the smallest of each bucket to which it isn't connected yet, ...
    left = _labelled(_labelled(stars.join(first, ["a", "b"], "left_anti"), labels, "a", "x"), labels, "b", "y")
    links = links.unionByName(durable(confirm(left.where("x <> y").select("a", "b"), sets, percent), "near-found"))
    labels = durable(components(links), "near-labels")
    # ... then with all others of its buckets in other components.
    more = durable(_rest(members.select("band", "id"), labels, sets, percent, rows), "near-found")
    labels = durable(components(links.unionByName(more)), "near-labels")

    named = _labelled(classes, labels, "node", "label")
    lows = named.groupBy("label").agg(F.min("one").alias("low"))
    named = named.join(lows, "label").select(*same, F.col("low.doc_id").alias("component_id"), F.col("low.rid").alias("low"))
    out = d.select("rid", "doc_id", *same).join(named, same, "left")
    empty = F.col("n_shingles") == 0
    return d, out.select(
        "rid", "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (empty | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        (empty | (F.col("rid") == F.col("low"))).alias("first"))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates."""
    d, found = _search(bundled(docs, "doc_id", "text"), **options)
    kept = d.join(found.where("first").select("rid"), "rid", "left_semi")
    return unbundled(kept, docs.columns, "doc_id", "text")
