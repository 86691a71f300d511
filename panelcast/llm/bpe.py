"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's adjacent pairs wait in buckets, one per merge rank, each holding
linked-list positions.  A 64-way bitmap tree over the ranks finds the lowest
non-empty bucket with a find-first-set per level, so a step costs a few word
operations whatever the pre-token's length; entries whose pair has changed
since are stale and skipped.  Pre-tokens repeat, so each worker keeps a
bounded table of those already encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache
from heapq import heappop, heappush
from itertools import islice

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, texts

CACHE_ENTRIES = 1_000_000    # pre-tokens (and as many pieces) kept per worker, some 180 MB each
LONG_TEXT = 2_000_000        # characters beyond which matches are taken in portions
PORTION = 200_000


_BIT = [1 << i for i in range(4096)]     # words of 256 ranks each: a million ranks


class RankQueue:
    """Priority queue of (rank, position): lowest rank first, then leftmost.

    ``words[w]`` has a bit for each non-empty bucket among ranks 256*w to
    256*w+255, ``top`` a bit for each non-zero word."""

    __slots__ = ("words", "top", "buckets")

    def __init__(self, n_ranks: int):
        self.words = [0] * ((max(1, n_ranks) + 255) >> 8)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, pos: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [pos]
            w = rank >> 8
            word = self.words[w]
            self.words[w] = word | _BIT[rank & 255]
            if not word:
                self.top |= _BIT[w]
        else:
            heappush(bucket, pos)

    def pop(self) -> tuple[int, int]:
        w = (self.top & -self.top).bit_length() - 1
        word = self.words[w]
        low = word & -word
        rank = (w << 8) + low.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        self.words[w] = word ^ low
        if word == low:
            self.top ^= _BIT[w]
        return rank, bucket[0]


# A space beside other white space.  Where a text has none, each of its single
# spaces begins a match, so what lies between two of them splits by itself.
_WIDE_SPACE = re.compile(r" \s|\s ")


class _Pieces(dict):
    """Text between two single spaces -> packed ids of a space and that text."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        enc = self.encoder
        packed = b"".join(map(enc.__getitem__, enc.find(" " + piece)))
        if len(piece) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed


class Encoder(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers; missing
    ones are encoded on access.  The pattern must let a match begin at a space
    between two other characters, as GPT-style patterns do."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.pieces = _Pieces(self)
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.vocab: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.vocab[rank] = token

    def __missing__(self, token: str) -> bytes:
        packed = array("I", self.merge(token.encode())).tobytes()
        if len(token) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[token] = packed
        return packed

    def merge(self, piece: bytes) -> list[int]:
        ranks, queue = self.ranks, self.queue
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        if n == 2:
            return [ranks[piece[:1]], ranks[piece[1:]]]
        get, push, pop = ranks.get, queue.push, queue.pop
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [get(piece[i:i + 2]) for i in range(n)]      # rank of the pair that begins here, None if it can't merge
        pair[n - 1] = None                                  # the last byte begins none
        for i, r in enumerate(pair):
            if r is not None:
                push(r, i)
        while queue.top:
            r, i = pop()
            if pair[i] != r:                       # stale
                continue
            j = after[i]
            k = after[j]
            after[i], pair[j] = k, None
            r = None
            if k < n:
                before[k] = i
                r = get(piece[i:after[k]])
                if r is not None:
                    push(r, i)
            pair[i] = r
            p = before[i]
            if p >= 0:
                r = pair[p] = get(piece[p:k])
                if r is not None:
                    push(r, p)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i:after[i]]])
            i = after[i]
        return ids

    def portions(self, text: str):
        """Ids of the text, packed, a bounded portion at a time."""
        if len(text) > LONG_TEXT:
            matches = (m.group() for m in self.find.__self__.finditer(text))
            while part := list(islice(matches, PORTION)):
                yield b"".join(map(self.__getitem__, part))
        elif _WIDE_SPACE.search(text):
            yield b"".join(map(self.__getitem__, self.find(text)))
        else:
            first, *rest = text.split(" ")
            yield b"".join(map(self.__getitem__, self.find(first)))
            yield b"".join(map(self.pieces.__getitem__, rest))

    def decode(self, packed: bytes) -> bytes:
        ids = array("I")
        ids.frombytes(packed)
        return b"".join(map(self.vocab.__getitem__, ids))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of a rank file."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Encoder(ranks, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(doc_id, ids): the text's ids by the rank file at ``path``, which every
    executor must have (an installed package's file).  Null text: no ids;
    other columns are not used; repeated rows give repeated rows."""

    def run(b):
        enc = encoder(path, pattern)
        ids = []
        for t in texts(b, "text"):
            a = array("I")
            for part in enc.portions(t):
                a.frombytes(part)
            ids.append(a.tolist())
        return {"doc_id": b.column("doc_id"), "ids": ids}

    return map_rows(docs.select("doc_id", F.col(text).alias("text")),
                    f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>", run)


def decode(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that are no UTF-8 become U+FFFD."""

    def run(b):
        enc = encoder(path, pattern)
        return {"doc_id": b.column("doc_id"),
                "text": [enc.decode(array("I", x or []).tobytes()).decode(errors="replace")
                         for x in b.column("ids").to_pylist()]}

    return map_rows(ids.select("doc_id", "ids"),
                    f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, text string", run)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded
    and decoded in one pass, a bounded portion at a time.  Null text: empty."""

    def run(b):
        enc = encoder(path, pattern)
        n, ids_sha, text_sha = [], [], []
        for t in texts(b):
            count, h_ids, h_text = 0, hashlib.sha256(), hashlib.sha256()
            for part in enc.portions(t):
                count += len(part) // 4
                h_ids.update(part)
                h_text.update(enc.decode(part))
            n.append(count)
            ids_sha.append(h_ids.hexdigest())
            text_sha.append(h_text.hexdigest())
        return {"doc_id": b.column("doc_id"), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    return map_rows(docs.select("doc_id", "text"),
                    f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, "
                    "ids_sha256 string, decoded_sha256 string", run)
