"""Packing documents into fixed windows by non-negative least squares.

Whole windows of a long document stand alone.  What is left of each document
has a length below the window; combinations of two or three such lengths that
fill a window are enumerated, non-negative least squares finds how often to
use each so that the histogram of lengths is met, the counts are rounded, and
documents are dealt to combinations by their rank among those of their length.
What no combination takes is packed greedily, cut at window ends; the last
window is cut into powers of two, so nothing is padded.

Only the histogram (one row per length) reaches the driver.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, texts

WINDOW = 2048
ITERATIONS = 300
CACHE_ENTRIES = 1_000_000      # words kept in each worker, some 180 MB
_PID = 33                # monotonically_increasing_id: partition above, row below this bit


# Letters whose lower case is one letter in any Unicode version and which no normal form changes.
_LETTERS = r"A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF"
_MARKS = r"!-&(-/:-@\[-`{-~"                           # ASCII marks but the apostrophe, which may belong to letters
_PLAIN = re.compile(f"[{_LETTERS}0-9{_MARKS}]+")
_PARTS = re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")  # what the tokenizer takes apart in such a piece

_WIDE = re.compile(r"[^\x00-\xFF]")
_RUN = re.compile(r"[^A-Za-z0-9\xC0-\xD6\xD8-\xF6\xF8-\xFF ][.,]")      # maybe a mark that the stop or comma belongs to


def _pieces(text: str) -> list[str]:
    """Strings that can be encoded apart: what lies between blanks and line
    feeds, in Latin-1 texts in lower case and without a final stop or comma."""
    text = text.replace("\n", " ")
    if not _WIDE.search(text):
        text = text.lower()
        if not _RUN.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


class _Words(dict):
    """Piece of text without blank or line feed -> its ids, packed."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model
        # Letters in the form that the tokenizer's model sees, for words that need no other step.
        letters = [c for c in map(chr, [*range(97, 123), *range(0xDF, 0x100)]) if c != "\xF7"]
        self.letters = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def __missing__(self, piece: str) -> bytes:
        parts = _PARTS.findall(piece.lower()) if _PLAIN.fullmatch(piece) else ()
        if len(parts) > 1:
            packed = b"".join(map(self.__getitem__, parts))
        elif parts and parts[0].isalpha():
            word = parts[0] if parts[0].isascii() else parts[0].translate(self.letters)
            packed = self.pack([t.id for t in self.model.tokenize(word)])
        else:
            packed = self.pack(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        # A full table stays: the words that came early are the frequent ones.
        if len(piece) <= 64 and len(self) < CACHE_ENTRIES:
            self[piece] = packed
        return packed


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def tokenize(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """(rid, doc_id, n, ids): each whole text's ids and the end id as packed
    little-endian integers (16 bits if the vocabulary allows, else 32).  The
    tokenizer must split at white space, so that words can be encoded apart.
    Null text: the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        end = np.array([end_id], words.dtype).tobytes()
        for b in batches:
            ids = [b"".join(map(words.__getitem__, _pieces(t))) + end for t in texts(b)]
            n = [len(x) // words.dtype.itemsize for x in ids]
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("doc_id"), pa.array(n, pa.int64()),
                                              pa.array(ids, pa.binary())], names=["rid", "doc_id", "n", "ids"])

    d = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return d.mapInArrow(run, f"rid long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, ids binary")


def combinations(hist: np.ndarray, window: int) -> np.ndarray:
    """All rows of three lengths (0: none) present in the histogram that sum to
    the window: some 350,000 for 2048."""
    has = hist > 0
    a = np.arange((window + 1) // 2, window)
    a = a[has[a] & has[window - a]]
    pairs = np.stack([a, window - a, np.zeros_like(a)], 1)
    present = np.flatnonzero(has[:window // 2 + 1])
    present = present[present > 0]
    b, c = np.meshgrid(present, present, indexing="ij")
    ok = (b >= c) & (window - b - c >= b)
    b, c = b[ok], c[ok]
    ok = has[window - b - c]
    b, c = b[ok], c[ok]
    return np.concatenate([pairs, np.stack([window - b - c, b, c], 1)])


def solve(hist: np.ndarray, combos: np.ndarray) -> np.ndarray:
    """Non-negative least squares of the combinations' uses against the
    histogram, by accelerated projected gradients."""
    if not len(combos):
        return np.zeros(0)
    columns = [np.ascontiguousarray(c) for c in combos.T]

    def times(x):
        y = sum(np.bincount(c, x, minlength=len(hist)) for c in columns)
        y[0] = 0                                             # no third length
        return y

    def transposed(y):
        y = y.copy()
        y[0] = 0
        return sum(y[c] for c in columns)

    v = np.ones(len(combos))
    for _ in range(20):
        v = transposed(times(v))
        top = np.linalg.norm(v)
        v /= top
    step = 1 / (1.05 * top)
    x = z = np.zeros(len(combos))
    t = 1.0
    for _ in range(ITERATIONS):
        new = np.maximum(0, z - step * transposed(times(z) - hist))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def rounded(hist: np.ndarray, combos: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole counts near x that use no length more often than there is."""
    left = hist.astype(np.int64).copy()
    counts = np.zeros(len(combos), np.int64)
    for whole in (True, False):
        share = x if whole else x - np.floor(x)
        for i in np.argsort(-share, kind="stable"):
            want = int(x[i]) if whole else int(share[i] > 1e-6)
            if want:
                parts = [p for p in combos[i].tolist() if p]
                n = min(want, *(int(left[p]) // parts.count(p) for p in parts))
                if n > 0:
                    counts[i] += n
                    for p in parts:
                        left[p] -= n
    return counts


def _deal(combos: np.ndarray, counts: np.ndarray) -> tuple[dict, int]:
    """By length: ends of rank intervals, first rank, first sequence and offset of each."""
    table: dict[int, list] = {}
    sequence = 0
    filled: dict[int, int] = {}
    for parts, n in zip(combos.tolist(), counts.tolist(), strict=True):
        if n:
            offset = 0
            for p in parts:
                if p:
                    lo = filled.get(p, 0)
                    filled[p] = lo + n
                    table.setdefault(p, []).append((lo + n, lo, sequence, offset))
                    offset += p
            sequence += n
    return {p: np.array(v, np.int64).T for p, v in table.items()}, sequence


def _ends(total: int, window: int) -> list[int]:
    """Ends of the sequences of the last, unfilled window: powers of two."""
    at = total - total % window
    ends = []
    for bit in reversed(range(window.bit_length())):
        if (total - at) >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def _before(df: DataFrame, value: str, name: str, *keys: str) -> DataFrame:
    """Exclusive running sum of ``value`` by rid (for each of ``keys``), by
    way of sums for each input partition."""
    df = df.withColumn("_pid", F.shiftright("rid", _PID))
    inner = Window.partitionBy("_pid", *keys).orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy("_pid", *keys).agg(F.sum(value).alias("_s"))      # at most one row per partition and key
    outer = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_pid", *keys, F.coalesce(F.sum("_s").over(outer), F.lit(0)).alias("_o"))
    return (df.withColumn("_i", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(sums, ["_pid", *keys]).withColumn(name, F.col("_i") + F.col("_o")).drop("_pid", "_i", "_o"))


def layout(lengths: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, full_sequence, pieces) from (rid, n): the first sequence id of the
    document's whole windows, and the pieces (start, length, sequence_id,
    offset) of the rest."""
    w = window
    d = lengths.select("rid", "n", F.floor(F.col("n") / w).alias("full"), (F.col("n") % w).cast("int").alias("r"),
                       F.lit(1).alias("one"))
    hist = np.zeros(w + 1, np.int64)
    for r in d.where("r > 0").groupBy("r").agg(F.sum("one").alias("c")).collect():
        hist[r["r"]] = r["c"]
    combos = combinations(hist, w)
    table, n_sequences = _deal(combos, rounded(hist, combos, solve(hist.astype(float), combos)))
    taken = np.zeros(w + 1, np.int64)
    for p, v in table.items():
        taken[p] = v[0, -1]
    rest_tokens = int(((hist - taken) * np.arange(w + 1)).sum())
    ends = _ends(rest_tokens, w)
    first_full = n_sequences + rest_tokens // w + len(ends)

    ranked = _before(d, "one", "rank", "r")
    kind = "rid long, n long, full long, r int, sequence_id long, offset long, rest int"

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seq, off = np.full(len(b), -1, np.int64), np.zeros(len(b), np.int64)
            rank, r = b["rank"].to_numpy(), b["r"].to_numpy()
            for p in np.unique(r).tolist():
                if p in table:
                    at = np.flatnonzero((r == p) & (rank < taken[p]))
                    stop, lo, base, offset = table[p]
                    i = np.searchsorted(stop, rank[at], side="right")
                    seq[at], off[at] = base[i] + rank[at] - lo[i], offset[i]
            yield pd.DataFrame({"rid": b["rid"], "n": b["n"], "full": b["full"], "r": r, "sequence_id": seq,
                                "offset": off, "rest": np.where(seq < 0, r, 0)})

    dealt = ranked.select("rid", "n", "full", "r", "rank").mapInPandas(deal, kind)
    dealt = _before(_before(durable(dealt, "packing-dealt"), "rest", "at"), "full", "full_sequence")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for n, r, seq, off, at in zip(b["n"], b["r"], b["sequence_id"], b["offset"], b["at"], strict=True):
                start = n - r
                if not r:
                    out.append([])
                elif seq >= 0:
                    out.append([(start, r, seq, off)])
                else:
                    row = []
                    while r:
                        whole = rest_tokens - rest_tokens % w
                        if at < whole:
                            s, o, room = at // w, at % w, w - at % w
                        else:
                            i = next(i for i, e in enumerate(ends) if at < e)
                            s, o, room = whole // w + i, at - (ends[i - 1] if i else whole), ends[i] - at
                        take = min(r, room)
                        row.append((start, take, n_sequences + s, o))
                        start, r, at = start + take, r - take, at + take
                    out.append(row)
            yield pd.DataFrame({"rid": b["rid"], "full_sequence": first_full + b["full_sequence"],
                                "pieces": [[dict(zip(("start", "length", "sequence_id", "offset"), map(int, p), strict=True))
                                            for p in row] for row in out]})

    return dealt.mapInPandas(pieces, "rid long, full_sequence long, "
                             "pieces array<struct<start:long,length:long,sequence_id:long,offset:long>>")


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of
    each piece, with ``ids`` too if asked.  A null text is the end id alone;
    repeated rows are packed each; other columns are not used.  Sequences are
    full windows or powers of two."""
    tokens = durable(tokenize(docs, path, end_id), "packing-ids")
    plan = layout(tokens.select("rid", "n"), window)
    item = "ids array<int>, " if with_ids else ""
    doc_kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6 + ([pa.list_(pa.int32())] if with_ids else [])
        names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        for b in batches:
            owner, rows = [], []
            for i, (n, ids, full, parts) in enumerate(zip(
                    b.column("n").to_pylist(), b.column("ids").to_pylist(), b.column("full_sequence").to_pylist(),
                    b.column("pieces").to_pylist(), strict=True)):
                x = np.frombuffer(ids, f"<u{len(ids) // n}").astype("<u4")
                spans = [(k * window, window, full + k, 0) for k in range(n // window)]
                spans += [(p["start"], p["length"], p["sequence_id"], p["offset"]) for p in parts]
                for start, length, sequence, offset in spans:
                    own = x[start:start + length]
                    owner.append(i)
                    rows.append((start, length, zlib.crc32(own.tobytes()), n, sequence, offset)
                                + ((own.tolist(),) if with_ids else ()))
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else \
                [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(owner, pa.int64())), *cols],
                                             names=["doc_id", *names])

    out = tokens.join(plan, "rid").select("doc_id", "n", "ids", "full_sequence", "pieces").mapInArrow(
        cut, f"doc_id {doc_kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             f"offset long{', ' + item[:-2] if item else ''}")
    return out
