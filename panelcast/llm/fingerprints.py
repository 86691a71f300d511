"""Document fingerprints by locally consistent parsing.

A text's symbols are cut into phrases at landmarks that deterministic coin
tossing finds from a few neighbours alone; a phrase's name is a hash of its
symbols, and the names are parsed again, level by level.  Equal substrings get
equal names but for a few phrases at their ends, wherever they stand.  The
fingerprint is a bottom-k sketch of the names of the upper levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH = 64              # names kept of a document
FIRST_LEVEL, LEVELS = 2, 6
PORTION = 400_000        # symbols parsed at once, unless one text is longer
BUCKET_BYTES = 8 << 20   # text in one bucket of neighbouring documents ...
MAX_BUCKETS = 20_000     # ... unless that gives more buckets than this: their bounds are held on the driver

_TRAILING = np.array([8] + [(i & -i).bit_length() - 1 for i in range(1, 256)], np.uint8)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (multiply and shift)."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(64, _STEP | np.uint64(1), np.uint64))


def _parse(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each document's symbols, and their documents."""
    # A run of one symbol becomes one symbol, so that neighbours differ.
    first = np.empty(len(x), bool)
    first[0] = True
    np.not_equal(doc[1:], doc[:-1], out=first[1:])
    keep = first.copy()
    keep[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(keep)
    if len(at) < len(x):
        length = np.diff(at, append=len(x)).astype(np.uint64)
        x = x[at]
        x = np.where(length > 1, _mix(x + length * _STEP), x)
        doc, first = doc[at], first[at]
    # Coin tossing: twice the lowest bit position in which a symbol differs
    # from the one before, plus its bit there.  Four rounds leave 6 labels.
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = x[first] ^ np.uint64(1)
    diff = x ^ before
    low = np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1))
    label = (low << 1) | ((x >> low.astype(np.uint64)).astype(np.uint8) & 1)
    for _ in range(3):
        prev = np.empty_like(label)
        prev[1:] = label[:-1]
        prev[first] = label[first] ^ 1
        low = _TRAILING[label ^ prev]
        label = (low << 1) | ((label >> low) & 1)
    # Landmarks: local maxima, and each document's first symbol.
    mark = first.copy()
    if len(x) > 2:
        mark[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
    start = np.flatnonzero(mark)
    size = np.diff(start, append=len(x))
    offset = np.arange(len(x)) - np.repeat(start, size)
    name = _mix(np.add.reduceat(_mix(x + _STEP) * _POWERS[offset & 63], start))
    return name, doc[start]


def sketches(texts: list[str], k: int = SKETCH) -> list[np.ndarray]:
    """The k smallest distinct 32-bit name hashes of each text, ascending."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        end, n = at, 0
        while end < len(texts) and (end == at or n + len(texts[end]) <= PORTION):
            n += len(texts[end])
            end += 1
        out += _sketch_portion(texts[at:end], k)
        at = end
    return out


def _sketch_portion(texts: list[str], k: int) -> list[np.ndarray]:
    sizes = [len(t) for t in texts]
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    none = np.empty(0, np.uint32)
    if not len(x):
        return [none] * len(texts)
    x = _mix(x)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    found = []
    for level in range(1, LEVELS + 1):
        x, doc = _parse(x, doc)
        if level >= FIRST_LEVEL:
            short = _mix(x + np.uint64(level)) >> np.uint64(32)
            found.append((doc.astype(np.uint64) << np.uint64(32)) | short)
    keys = np.unique(np.concatenate(found))
    owner = (keys >> np.uint64(32)).astype(np.int64)
    begin = np.searchsorted(owner, np.arange(len(texts)))
    stop = np.append(begin[1:], len(keys))
    value = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [value[b:min(e, b + k)] if e > b else none for b, e in zip(begin, stop, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Estimated share of the two documents' phrases that are common (Dice);
    two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[:-1] == both[1:]
    union = both[np.append(True, ~twice)]
    size = min(k, len(union))
    common = int(np.count_nonzero(both[:-1][twice] <= union[size - 1]))
    j = common / size
    return 2 * j / (1 + j)


def to_string(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """(doc_id, fingerprint) of each text; null as empty, whose fingerprint is
    the empty string."""
    def run(batches):
        for b in batches:
            t = [x or "" for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([to_string(s) for s in sketches(t, k)])], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, halo, doc_id, text), sorted within partitions so that the row
    after each is the next document by descending doc_id (null lowest; ties by
    length and text).

    Buckets are ranges of doc_id.  Each also gets, as halo rows sorted last,
    the first documents of the bucket below it (the lowest: those of the
    highest), so no bucket needs another.  Only the buckets' bounds are
    collected, at most ``MAX_BUCKETS``; larger buckets are sorted on disk and
    streamed, so their size is not held in memory."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, size = d.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    buckets = max(1, min(MAX_BUCKETS, -(-(size or 0) // BUCKET_BYTES)))
    cuts = d.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets) if n and buckets > 1 else []
    cuts = np.array(sorted({int(c) for c in cuts}), np.int64)

    def bucket_of(ids: pa.Array) -> np.ndarray:
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        return np.where(valid, np.searchsorted(cuts, ids.fill_null(0).to_numpy(), side="right"), -1)

    def only_bucket(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bucket_of(b.column(0)), pa.int64())],
                                             names=["doc_id", "bucket"])

    heads = {r["bucket"]: r["head"] for r in d.select("doc_id").mapInArrow(only_bucket, "doc_id long, bucket long")
             .groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)                                  # ascending
    above = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}

    def deal(batches):
        for b in batches:
            own = bucket_of(b.column("doc_id"))
            ids = b.column("doc_id").to_pylist()
            halo = [i for i, x in enumerate(own.tolist()) if heads[x] == ids[i]]
            every = pa.array([*range(len(own)), *halo], pa.int64())
            bucket = np.concatenate([own, np.array([above[int(own[i])] for i in halo], np.int64)])
            flag = np.concatenate([np.zeros(len(own), bool), np.ones(len(halo), bool)])
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(flag), *b.take(every).columns],
                                             names=["bucket", "halo", "doc_id", "text"])

    dealt = d.mapInArrow(deal, "bucket long, halo boolean, doc_id long, text string")
    return dealt.repartition(max(1, len(order)), "bucket").sortWithinPartitions(
        "bucket", "halo", F.col("doc_id").desc_nulls_last(), F.length("text"), "text")


def compare_edited(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    """Fingerprints of each text and of its edited form, whose last half is
    replaced by the beginning of the next document, with the likeness of the
    fingerprint to the edited text's and to the next document's.  Null texts
    are empty; a single document follows itself; repeated rows give repeated
    rows."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(rows):
        """rows: (doc_id, text, next text)."""
        edited = [t[:len(t) - len(t) // 2] + nxt[:len(t) // 2] for _, t, nxt in rows]
        own = sketches([t for _, t, _ in rows] + [rows[-1][2]], k)
        other = sketches(edited, k)
        nexts = [own[i + 1] if i + 1 < len(rows) and rows[i][2] is rows[i + 1][1] else None for i in range(len(rows))]
        missing = [i for i, s in enumerate(nexts) if s is None]
        for i, s in zip(missing, sketches([rows[i][2] for i in missing], k), strict=True):
            nexts[i] = s
        cols = [[r[0] for r in rows], [len(r[1]) for r in rows],
                [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                [to_string(own[i]) for i in range(len(rows))], [to_string(s) for s in other],
                [likeness(own[i], other[i], k) for i in range(len(rows))],
                [likeness(own[i], nexts[i], k) for i in range(len(rows))]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last, chars = [], None, 0            # last: the row that waits for the one after it
        for b in batches:
            for bucket, halo, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if last is not None:               # a row is followed in its bucket, at the latest by a halo row
                    rows.append((last[1], last[2], text))
                    chars += len(last[2])
                    last = None
                if not halo:
                    last = (bucket, doc_id, text)
                if chars >= PORTION:
                    yield finish(rows)
                    rows, chars = [], 0
        if rows:
            yield finish(rows)

    return with_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                           "edited_fingerprint string, near_edited double, near_next double")
