"""Long repeated substrings, found with a run-length index.

Every window of ``span`` bytes is assigned to the smallest hash among its
short grams, so equal windows of any documents meet under one key, and
consecutive windows of one key form a segment.  Equal segments are counted
first (copies never travel as text).  The distinct segments of a key are then
indexed together: their Burrows-Wheeler transform is stored as runs with the
suffix-array samples at run ends, matching statistics are streamed over the
text from sample to sample, and matches of ``span`` bytes are marked.  Keys
with too much text for one task are decided by hashes of their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bundled, durable, flagged, quoted, release, scratch_owner, unbundled

SPAN = 400
GRAM = 64                # bytes of the grams that windows are assigned by
SEGMENT = 2048           # windows in a segment at most
INDEX_BYTES = 1 << 20    # text indexed at once
HOT_BYTES = 4 << 20      # text of one key beyond which its windows are hashed instead
# Passages of over 50 words: runs of repeated strings of 256 bytes, some 50 words of four letters, that have that
# many words or SPAN bytes.
PASSAGE = {"span": 256, "gram": 32, "min_words": 50, "any_bytes": SPAN}
_SEP = 0xFF              # no byte of UTF-8
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M1
    return x ^ (x >> np.uint64(29))


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one big-endian number (length n-7)."""
    out = data[:len(data) - 7].astype(np.uint64)
    for i in range(1, 8):
        out <<= np.uint64(8)
        out |= data[i:len(data) - 7 + i]
    return out


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position; gram is 8 * 2**k."""
    h, size = _mix(_words(data)), 8
    while size < gram:
        h = _mix(h[:-size] * _M2 + h[size:])
        size *= 2
    return h


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    n = len(h)
    pad = -n % w
    blocks = np.concatenate([h, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def segments(data: bytes, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(key, digest high, digest low, start, windows, several) of the segments
    of a text; ``several`` where the key's gram occurs more than once in the
    segment, so that it may repeat itself."""
    x = np.frombuffer(data, np.uint8)
    if len(x) < span:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int32, bool))
    w = span - gram + 1
    h = _gram_hashes(x, gram)
    m = _sliding_min(h, w)
    cut = np.flatnonzero(m[1:] != m[:-1]) + 1
    start = np.concatenate([[0], cut])
    count = np.diff(start, append=len(m))
    if count.max() > SEGMENT:
        parts = -(-count // SEGMENT)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        left = np.repeat(count, parts) - within * SEGMENT
        start, count = np.repeat(start, parts) + within * SEGMENT, np.minimum(left, SEGMENT)
    key = m[start]
    digests, several = [], []
    view = memoryview(data)
    for s, n, k in zip(start.tolist(), count.tolist(), key, strict=True):
        digests.append(xxhash.xxh3_128_digest(view[s:s + n + span - 1]))
        several.append(np.count_nonzero(h[s:s + n + w - 1] == k) > 1)
    d = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    return (key.view(np.int64), d[:, 0], d[:, 1], start.astype(np.int32), count.astype(np.int32), np.array(several, bool))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling or tripling; only suffixes that still tie are sorted again."""
    n = len(text)
    key = _words(np.concatenate([text, np.zeros(7, np.uint8)]))
    # Equal keys of suffixes that reach the end: the shorter comes first, before those that go on.
    inner = max(0, n - 7)
    order = np.argsort(key[:inner])
    last = np.arange(n - 1, inner - 1, -1)
    last = last[np.argsort(key[last], kind="stable")]
    order = np.insert(order, np.searchsorted(key[order], key[last]), last)
    tie = (key[order][1:] == key[order][:-1]) & (order[1:] < inner) & (order[:-1] < inner)
    head = np.concatenate([[True], ~tie])
    rank = np.zeros(n + 1, np.int64)           # 0: behind the end
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    open_at = np.flatnonzero(~head | np.append(tie, False))      # places of suffixes that tie
    step, fold = 8, 3 if n < 2_000_000 else 2    # three ranks in a number, or two
    while len(open_at):
        which = order[open_at]
        sign = rank[which]
        for k in range(1, fold):
            sign = sign * (n + 1) + rank[np.minimum(which + k * step, n)]
        place = np.argsort(sign)
        which, sign = which[place], sign[place]
        new = np.concatenate([[True], sign[1:] != sign[:-1]])
        order[open_at] = which
        rank[which] = np.maximum.accumulate(np.where(new, open_at, 0)) + 1
        open_at = open_at[~(new & np.append(new[1:], True))]
        step *= fold
    return order


class RunIndex:
    """Run-compressed Burrows-Wheeler transform with samples at run ends.

    ``heads`` and ``lengths`` are the runs.  For the first suffix of each run
    ``at`` holds its text position and ``before`` that of the suffix above it,
    which ends the run before; ordered by ``at``.  Between two samples the
    neighbour moves along with the position and the match gets shorter by one,
    so a match length at each sample gives the matching statistics of all
    positions."""

    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        bwt = text[order - 1]
        change = np.empty(len(order), bool)
        change[0] = True
        np.not_equal(bwt[1:], bwt[:-1], out=change[1:])
        change |= bwt == _SEP            # no match goes on over a separator
        # The suffix that begins the text has nothing before it: its neighbours start runs.
        zero = int(np.flatnonzero(order == 0)[0])
        change[zero] = True
        if zero + 1 < len(order):
            change[zero + 1] = True
        runs = np.flatnonzero(change)
        self.text, self.heads, self.lengths = text, bwt[runs], np.diff(runs, append=len(order))
        runs = runs[1:]
        at, before = order[runs], order[runs - 1]
        place = np.argsort(at)
        self.at, self.before = at[place], before[place]

    def matches(self) -> np.ndarray:
        """Length of the match at each sample, to the next separator at most."""
        n = len(self.text)
        padded = np.concatenate([self.text, np.full(8, _SEP, np.uint8)])
        word = _words(padded)
        length = np.zeros(len(self.at), np.int64)
        active = np.arange(len(self.at))
        while len(active):
            a, b = self.at[active] + length[active], self.before[active] + length[active]
            inside = (a < n) & (b < n)
            diff = np.where(inside, word[np.minimum(a, n - 1)] ^ word[np.minimum(b, n - 1)], np.uint64(1) << np.uint64(63))
            same = diff == 0
            equal = sum((diff >> np.uint64(56 - 8 * i)) == 0 for i in range(8))      # leading bytes
            length[active] += np.where(same, 8, np.where(inside, equal, 0))
            active = active[same]
        stop = np.append(np.flatnonzero(self.text == _SEP), n)
        room = lambda p: stop[np.searchsorted(stop, p)] - p
        return np.minimum(length, np.minimum(room(self.at), room(self.before)))

    def repeated(self, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the text covered by strings of ``span`` bytes that
        start elsewhere too, as overlapping intervals."""
        length = self.matches()
        long = length >= span
        a, b, n = self.at[long], self.before[long], length[long]
        return np.concatenate([a, b]), np.concatenate([a + n, b + n])


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as disjoint, ascending ones that don't touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:], len(s)) - 1]


def _index_block(block: list[tuple], span: int) -> list[tuple]:
    """(rid, start, end) from (rid, start, bytes) of the distinct segments of some keys."""
    text = np.frombuffer(b"".join(x[2] + b"\xff" for x in block), np.uint8)
    begin = np.cumsum([0] + [len(x[2]) + 1 for x in block])
    s, e = merged(*RunIndex(text).repeated(span))
    owner = np.searchsorted(begin, s, side="right") - 1
    return [(block[i][0], block[i][1] + a, block[i][1] + b)
            for i, a, b in zip(owner.tolist(), (s - begin[owner]).tolist(), (e - begin[owner]).tolist(), strict=True)]


_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(0, 1 << 63, (2, 256), dtype=np.int64).astype(np.uint64)
_BASE = [0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1]


def _window_hashes(data: bytes, span: int) -> np.ndarray:
    """Two 64-bit polynomial hashes of each window."""
    x = np.frombuffer(data, np.uint8)
    out = []
    for table, base in zip(_BYTE, _BASE, strict=True):
        up = np.cumprod(np.full(len(x), base, np.uint64))
        down = np.cumprod(np.full(len(x), pow(base, -1, 1 << 64), np.uint64))
        total = np.concatenate([[np.uint64(0)], np.cumsum(table[x] * up)])
        out.append(_mix((total[span:] - total[:-span]) * down[:len(x) - span + 1]))
    return np.stack(out)


def find(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``docs`` (any columns, text among them) with _spans: (a, b) structs of
    byte intervals of the text covered by strings of ``span`` bytes that also
    start elsewhere, overlapping and in any order; null if there are none.
    Null texts are empty.  Equal rows are occurrences of their own.  Columns of
    any name may stand beside the text; one named _spans is replaced."""
    kept = [c for c in docs.columns if c != "_spans"]
    out = _find(bundled(docs.select(*map(quoted, kept)), "text"), span, gram, hot_bytes)
    return out.select(*[F.col(c) if c == "text" else F.col("_rest")[c].alias(c) for c in kept], "_spans")


def _find(docs: DataFrame, span: int, gram: int, hot_bytes: int) -> DataFrame:
    d = _stored(docs)
    return d.join(_marks(d, span, gram, hot_bytes), "_rid", "left").select(*docs.columns, "_spans")


def _stored(docs: DataFrame) -> DataFrame:
    return durable(docs.withColumn("_rid", F.monotonically_increasing_id()), "repeats-docs")


def _bytes(text: str | bytes | None) -> bytes:
    return text if isinstance(text, bytes) else (text or "").encode()


def _marks(d: DataFrame, span: int, gram: int, hot_bytes: int) -> DataFrame:
    """(_rid, _spans) of the rows of ``d`` (_rid, text and others; the text a
    string or pieces of UTF-8) that have any."""
    if gram < 8 or gram & (gram - 1) or gram > span:
        raise ValueError("gram must be a power of two from 8 to the span")
    spark = d.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rid", "m", "d1", "d2", "s", "n", "several"]
        for b in batches:
            rid = b.column("_rid").to_numpy()
            found = [segments(_bytes(t), span, gram) for t in b.column("text").to_pylist()]
            owner = np.repeat(rid, [len(x[0]) for x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner, pa.int64()), *(pa.array(np.concatenate(c)) for c in zip(*found, strict=True))], names=names)

    segs = durable(d.mapInArrow(cut, "rid long, m long, d1 long, d2 long, s int, n int, several boolean"), "repeats-segments")
    same = ["m", "d1", "d2"]
    kinds = segs.groupBy(*same).agg(F.count("*").alias("c"), F.min(F.struct("rid", "s", "n")).alias("one"),
                                    F.max("several").alias("several"))
    keys = (kinds.groupBy("m").agg(F.count("*").alias("k"), F.sum("c").alias("rows"), F.max("several").alias("any"),
                                   F.sum(F.col("one.n") + span - 1).alias("bytes"))
            .where((F.col("rows") > 1) | F.col("any")).select("m", "k", "bytes"))
    # Kinds of keys that occur once end here; the others are written, so that segments are counted once.
    found = durable(kinds.join(keys, "m").select(
        *same, "c", "one", ((F.col("k") > 1) | F.col("several")).alias("inside"),
        (F.col("bytes") > hot_bytes).alias("hot")), "repeats-kinds")
    # Segments with a copy are repeated as a whole.
    copied = found.where("c > 1").select(*same)
    whole = segs.join(copied, same).select("rid", F.col("s").alias("a"), (F.col("s") + F.col("n") + span - 1).alias("b"))
    # Of each kind, one goes to the index, or to the hashes if its key has too much text.
    wanted = (found.where("inside").groupBy(F.col("one.rid").alias("_rid")).agg(F.collect_list(F.struct(
        "m", F.col("one.s").alias("s"), F.col("one.n").alias("n"), "c", "hot")).alias("_want")))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for rid, t, want in zip(b.column("_rid").to_pylist(), b.column("text").to_pylist(),
                                    b.column("_want").to_pylist(), strict=True):
                data = _bytes(t)
                rows += [(x["m"], rid, x["s"], x["c"], x["hot"], data[x["s"]:x["s"] + x["n"] + span - 1]) for x in want]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types, strict=True)],
                                             names=["m", "rid", "s", "c", "hot", "data"])

    # Only the texts that are asked for move.
    asked = flagged(d.select("_rid", "text"), "_rid", wanted, "_asked").where("_asked").drop("_asked")
    taken = durable(asked.join(wanted, "_rid").mapInArrow(
        take, "m long, rid long, s int, c long, hot boolean, data binary"), "repeats-taken")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by key; a block holds whole keys."""
        def emit(block):
            rows = _index_block(block, span)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                               pa.array(cols[2], pa.int32())], names=["rid", "a", "b"])
        block, size, last = [], 0, None
        for b in batches:
            for m, rid, s, data in zip(b.column("m").to_pylist(), b.column("rid").to_pylist(), b.column("s").to_pylist(),
                                       b.column("data").to_pylist(), strict=True):
                if m != last and size >= INDEX_BYTES:
                    yield emit(block)
                    block, size = [], 0
                block.append((rid, s, data))
                size += len(data) + 1
                last = m
        if block:
            yield emit(block)

    indexed = (taken.where("NOT hot").select("m", "rid", "s", "data").repartition(parts, "m")
               .sortWithinPartitions("m").mapInArrow(index, "rid long, a int, b int"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rid, s, c, data in zip(b.column("rid").to_pylist(), b.column("s").to_pylist(), b.column("c").to_pylist(),
                                       b.column("data").to_pylist(), strict=True):
                h = _window_hashes(data, span).view(np.int64)
                n = h.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[0]), pa.array(h[1]), pa.array(np.full(n, rid)), pa.array(s + np.arange(n, dtype=np.int32)),
                     pa.array(np.full(n, c))], names=["h1", "h2", "rid", "a", "c"])

    hashed = taken.where("hot").mapInArrow(windows, "h1 long, h2 long, rid long, a int, c long")
    often = hashed.groupBy("h1", "h2").agg(F.sum("c").alias("t")).where("t > 1").select("h1", "h2")
    hot = hashed.join(often, ["h1", "h2"]).select("rid", "a", (F.col("a") + span).alias("b"))

    return (whole.unionByName(indexed).unionByName(hot).groupBy(F.col("rid").alias("_rid"))
            .agg(F.collect_set(F.struct("a", "b")).alias("_spans")))


def _runs(data: bytes, spans: list | None, min_words: int = 0, any_bytes: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the marked runs of ``data``; those of fewer than
    ``min_words`` words and ``any_bytes`` bytes are left out."""
    x = np.array([(r["a"], r["b"]) for r in spans or ()], np.int64).reshape(-1, 2)
    s, e = merged(x[:, 0], x[:, 1])
    if min_words:
        long = np.array([b - a >= any_bytes or len(data[a:b].split()) >= min_words
                         for a, b in zip(s.tolist(), e.tolist(), strict=True)], bool)
        s, e = s[long], e[long]
    return s, e


def _kept(data: bytes, spans: list | None, min_words: int = 0, any_bytes: int = 0) -> tuple[list[bytes], int, int]:
    """What is left of ``data``, bytes removed and runs removed; runs of fewer
    than ``min_words`` words and ``any_bytes`` bytes stay."""
    s, e = _runs(data, spans, min_words, any_bytes)
    pieces, at = [], 0
    for a, b in zip(s.tolist(), e.tolist(), strict=True):
        pieces.append(data[at:a])
        at = b
    return pieces + [data[at:]], int((e - s).sum()), len(s)


def _find_both(docs: DataFrame, span: int, gram: int, hot_bytes: int, short_span: int, short_gram: int) -> DataFrame:
    """``docs`` with _spans and, for strings of ``short_span`` bytes, _short.
    A repeated string of ``span`` bytes lies within a run of repeated shorter
    ones, so the longer are sought in those runs only."""
    if short_span > span:
        raise ValueError("a passage's span must not exceed the span")
    spark, d = docs.sparkSession, _stored(docs)
    scratch: list[str] = []
    with scratch_owner(scratch):
        marks = _marks(d, short_span, short_gram, hot_bytes)
    short = durable(marks.withColumnRenamed("_spans", "_short"), "repeats-short")
    release(spark, scratch)
    d = flagged(d, "_rid", short, "_some")
    some = d.where("_some").drop("_some").join(short, "_rid")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for rid, t, spans in zip(b.column("_rid").to_pylist(), b.column("text").to_pylist(),
                                     b.column("_short").to_pylist(), strict=True):
                data = _bytes(t)
                rows += [(rid, x, data[x:y]) for x, y in zip(*map(np.ndarray.tolist, _runs(data, spans)), strict=True)
                         if y - x >= span]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.binary()), strict=True)],
                                             names=["owner", "at", "text"])

    pieces = _stored(some.select("_rid", "text", "_short").mapInArrow(cut, "owner long, at int, text binary"))
    moved = F.transform("_spans", lambda x: F.struct((x.a + F.col("at")).alias("a"), (x.b + F.col("at")).alias("b")))
    long = (pieces.select("_rid", "owner", "at").join(_marks(pieces, span, gram, hot_bytes), "_rid")
            .groupBy(F.col("owner").alias("_rid")).agg(F.flatten(F.collect_list(moved)).alias("_spans")))
    out = some.join(long, "_rid", "left").select(*docs.columns, "_spans", "_short")
    none = [F.lit(None).cast(out.schema[c].dataType).alias(c) for c in ("_spans", "_short")]
    return out.unionByName(d.where("NOT _some").select(*docs.columns, *none))


def report(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot_bytes: int = HOT_BYTES,
           passage: dict | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): what is left of each
    text's bytes without those that ``find`` marks.  With ``passage`` (span,
    gram, min_words and any_bytes as in ``remove``) also n_passages and
    passage_bytes: the runs that ``remove`` would cut with these, and their
    bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            both = zip(b.column("text").to_pylist(), b.column("_spans").to_pylist(),
                       b.column("_short").to_pylist() if passage else [None] * b.num_rows, strict=True)
            for t, spans, short in both:
                data = _bytes(t)
                pieces, removed, n = _kept(data, spans)
                sha = hashlib.sha256()
                for p in pieces:
                    sha.update(p)
                row = [len(data), removed, n, sha.hexdigest()]
                if passage:
                    s, e = _runs(data, short, passage["min_words"], passage["any_bytes"])
                    row += [len(s), int((e - s).sum())]
                rows.append(row)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.string() if n == "kept_sha256" else pa.int64())
                                       for c, n in zip(cols, names, strict=True))], names=["doc_id", *names])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["n_passages", "passage_bytes"] * bool(passage)
    docs = docs.select("doc_id", "text")
    found = (_find_both(docs, span, gram, hot_bytes, passage["span"], passage["gram"]) if passage
             else find(docs, span, gram, hot_bytes))
    return found.mapInArrow(run, ", ".join([f"doc_id {kind}", *(
        f"{n} {'string' if n == 'kept_sha256' else 'long'}" for n in names)]))


def remove(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot_bytes: int = HOT_BYTES, min_words: int = 0,
           any_bytes: int = SPAN) -> DataFrame:
    """``docs`` with the marked bytes cut out of the text; a character that is
    cut in part goes.  With ``min_words``, a marked run is cut only if it has
    that many words or ``any_bytes`` bytes.  Columns of any name may stand
    beside the text."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, spans in zip(b.column("text").to_pylist(), b.column("_spans").to_pylist(), strict=True):
                out.append(b"".join(_kept(t.encode(), spans, min_words, any_bytes)[0]).decode(errors="ignore") if spans else t)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "text" else b.column(c) for c in own], names=own)

    d = bundled(docs, "text")
    own = d.columns
    return unbundled(_find(d, span, gram, hot_bytes).mapInArrow(run, d.schema), columns, "text")
