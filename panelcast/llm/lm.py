"""Language-model scores by a weighted backoff automaton.

States are histories of up to ``order`` - 1 words that occur in training.  A
state has an arc for each word seen after it, weighted with the smoothed
probability, and a failure arc to the state of the history without its first
word, weighted with the mass that smoothing leaves; the root, where the chain
of failures ends, has the unigrams.  One pass from left to right carries the
state of each text and adds up the weights.

Documents lie in blocks of bounded size.  A block sends the hashes and counts
of its n-grams, sorted and packed, to shards by the first bits of the hash;
each shard adds up the counts and answers every block for just the n-grams that
it asked for and whose count is not its own.  So a scoring task holds the part
of the model that its block needs, whatever the size of the whole.  A sender
has at most 2**fan_bits shards for each order.  Where a shard would have more
senders than that, the messages of so many senders are merged into one sender
of the next level, which asks shards of further bits and passes the answers on:
rows grow with the number of blocks times the levels, not with its square, and
no task holds much more than the n-grams of one block.

Smoothing: p(w|uv) = (c(uvw) + k(uv) p(w|v)) / (c(uv) + k(uv)) with
k(h) = KAPPA + ALPHA c(h) for each history h, down to p(w) =
(c(w) + 0.5) / (N + 0.5 (V + 1)); each sums to 1 over the vocabulary and one
unknown word.  A text begins with one word of its own, which is never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

BLOCK_BYTES = 8 << 20    # text in one block, unless one document has more
KAPPA, ALPHA = 2.0, 1.0
ORDER = 2                # words of the longest n-grams, unless the caller names another order
FAN_BITS = 8             # a sender has at most 2**FAN_BITS shards, a shard about as many senders
STRIDE = 256             # tokens of a text that are traversed after one another; longer texts go in such pieces

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_END, _BOS = 0x5851F42D4C957F2D, 0x14057B7EF767814F      # hashes of the end and of the beginning


def _mix(x):
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def _pack(a: np.ndarray) -> bytes:
    """Bytes of equal significance together, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def words(text: str | None) -> list[bytes]:
    """A-Z in lower case, between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, ids, train, sizes, vocabulary, codes): documents as numbers of
    their block's words; ``docs`` has doc_id, text and train."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, train, sizes, hashes, size = [], [], [], [], 0

        def emit():
            h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
            vocabulary, codes = np.unique(h, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([ids], pa.list_(id_kind)), pa.array([train], pa.list_(pa.bool_())),
                 pa.array([sizes], pa.list_(pa.int32())), pa.array([_pack(vocabulary)], pa.binary()),
                 pa.array([_pack(codes.astype(np.uint32))], pa.binary())],
                names=["block", "ids", "train", "sizes", "vocabulary", "codes"])

        for b in batches:
            id_kind = b.schema.field("doc_id").type
            for doc, text, flag in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(),
                                       b.column("train").to_pylist(), strict=True):
                w = words(text)
                ids.append(doc)
                train.append(bool(flag))
                sizes.append(len(w))
                hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w)))
                size += len(text or "") + 1
                if size >= block_bytes:
                    yield emit()
                    number += 1
                    ids, train, sizes, hashes, size = [], [], [], [], 0
        if ids:
            yield emit()

    return docs.select("doc_id", "text", "train").mapInArrow(
        run, f"block long, ids array<{kind}>, train array<boolean>, sizes array<int>, vocabulary binary, codes binary")


class Block:
    """The n-grams of a block.  For each order k: their hashes in ascending
    order, the training counts in the block, the code of each token's n-gram
    (-1: the text is too short before it), and of each n-gram its history, its
    last word and the n-gram of order k-1 that it ends in."""

    def __init__(self, train: list, sizes: list, vocabulary: bytes, codes: bytes, order: int = ORDER):
        words_of = np.concatenate([_unpack(vocabulary, np.uint64), np.array([_END, _BOS], np.uint64)])
        n = len(words_of) - 2
        sizes = np.array(sizes, np.int64)
        self.sizes = sizes + 1                               # with the end
        self.first = np.cumsum(self.sizes) - self.sizes
        last = self.first + sizes
        total = int(self.sizes.sum())
        word = np.full(total, n, np.int64)
        inner = np.ones(total, bool)
        inner[last] = False
        word[inner] = _unpack(codes, np.uint32)
        seen = np.repeat(np.array(train, bool), self.sizes)
        count = np.bincount(word[seen], minlength=n + 2)
        count[n + 1] = int(np.count_nonzero(train))          # texts that begin
        self.n, self.word, self.top = n, word, order
        self.code, self.parent, self.last, self.suffix = {1: word}, {}, {}, {}
        self.order, self.hashes, self.counts = {}, {}, {}
        own = words_of
        for k in range(1, order + 1):
            if k > 1:
                before = np.empty(total, np.int64)
                before[1:] = self.code[k - 1][:-1]
                before[self.first] = n + 1 if k == 2 else -1
                at = np.flatnonzero(before >= 0)
                gram, first, place = np.unique(before[at] * (n + 2) + word[at], return_index=True, return_inverse=True)
                self.parent[k], self.last[k] = np.divmod(gram, n + 2)
                self.suffix[k] = self.code[k - 1][at[first]]
                self.code[k] = np.full(total, -1, np.int64)
                self.code[k][at] = place
                count = np.bincount(place[seen[at]], minlength=len(gram))
                own = _mix(own[self.parent[k]] * _M2 + _mix(words_of[self.last[k]] + np.uint64(2)))
            self.order[k] = np.argsort(own)
            self.hashes[k], self.counts[k] = own[self.order[k]], count[self.order[k]].astype(np.uint64)


_MESSAGE = pa.schema([("shard", pa.int64()), ("unit", pa.int64()), ("k", pa.int32()), ("at", pa.int64()),
                      ("hashes", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("unit", pa.int64()), ("k", pa.int32()), ("places", pa.binary()), ("totals", pa.binary()),
                     ("kinds", pa.int64())])
_UNIT = pa.schema([("unit", pa.int64()), ("shard", pa.int64()), ("k", pa.int32()), ("hashes", pa.binary()),
                   ("counts", pa.binary())])
_MESSAGE_DDL = "shard long, unit long, k int, at long, hashes binary, counts binary"
_ANSWER_DDL = "unit long, k int, places binary, totals binary, kinds long"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _groups(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[dict]]:
    """Rows that follow one another and agree in ``names``."""
    for _, rows in groupby((r for b in batches for r in b.to_pylist()), key=lambda r: [r[n] for n in names]):
        yield list(rows)


def _sent(unit: int, k: int, h: np.ndarray, c: np.ndarray, bits: int) -> list[tuple]:
    """Messages of a sender to the shards of its hashes' first ``bits`` bits."""
    shard = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    return [(int(shard[a]), unit, k, a, _pack(np.diff(h[a:e], prepend=np.uint64(0))), _pack(c[a:e]))
            for a, e in zip(cut.tolist(), [*cut[1:].tolist(), len(h)], strict=True)]


def _added(rows: list[dict]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each message, all hashes, each message's places among them one
    after another, and the sums."""
    h = [np.cumsum(_unpack(r["hashes"], np.uint64), dtype=np.uint64) for r in rows]
    c = [_unpack(r["counts"], np.uint64) for r in rows]
    every, place = np.unique(np.concatenate(h), return_inverse=True)
    return c, every, place, np.bincount(place, np.concatenate(c), minlength=len(every)).astype(np.uint64)


def _differing(rows: list[dict], counts: list, place: np.ndarray, total: np.ndarray, kinds: int) -> list[tuple]:
    """Answers to the messages: where a sender's count is not the sum."""
    out, start = [], 0
    for r, own in zip(rows, counts, strict=True):
        mine = total[place[start:start + len(own)]]
        start += len(own)
        other = np.flatnonzero(mine != own)
        out.append((r["unit"], r["k"], _pack((r["at"] + other).astype(np.uint32)), _pack(mine[other]), 0 if out else kinds))
    return out


def _requests(packed: DataFrame, bits: int, order: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                own = Block(r["train"], r["sizes"], r["vocabulary"], r["codes"], order)
                for k in range(1, order + 1):
                    yield _batch(_sent(r["block"], k, own.hashes[k], own.counts[k], bits), _MESSAGE)

    return packed.select("block", "train", "sizes", "vocabulary", "codes").mapInArrow(run, _MESSAGE_DDL)


def _answers(requests: DataFrame, parts: int) -> DataFrame:
    """(unit, k, places, totals, kinds): where a sender's counts differ from
    those of all; kinds, once for each shard and order, the number of distinct
    n-grams in the training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "shard", "k"):
            counts, every, place, total = _added(rows)
            kinds = int(np.count_nonzero(total))
            if rows[0]["k"] == 1:
                kinds -= bool(np.any((every == np.uint64(_BOS)) & (total > 0)))
            yield _batch(_differing(rows, counts, place, total, kinds), _ANSWER)

    return requests.repartition(parts, "shard").sortWithinPartitions("shard", "k", "unit").mapInArrow(run, _ANSWER_DDL)


def _totals(requests: DataFrame, senders: int, bits: int, fan_bits: int, parts: int) -> DataFrame:
    """Answers to ``requests``, whose shards are the first ``bits`` bits and
    have at most ``senders`` senders each."""
    if senders <= 1 << fan_bits:
        return durable(_answers(requests, parts), "lm-answers")
    teams = -(-senders // (1 << fan_bits))
    team = F.col("shard") * teams + F.pmod(F.xxhash64("unit"), F.lit(teams))
    sent = durable(requests.withColumn("team", team), "lm-requests")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "team", "k"):
            _, every, _, total = _added(rows)
            yield _batch([(rows[0]["team"], rows[0]["shard"], rows[0]["k"],
                           _pack(np.diff(every, prepend=np.uint64(0))), _pack(total))], _UNIT)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                h = np.cumsum(_unpack(r["hashes"], np.uint64), dtype=np.uint64)
                yield _batch(_sent(r["unit"], r["k"], h, _unpack(r["counts"], np.uint64), bits + fan_bits), _MESSAGE)

    def hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A team's answers come first, then its members' messages."""
        for rows in _groups(batches, "team", "k"):
            heard = [r for r in rows if r["hashes"] is None]
            members = [r for r in rows if r["hashes"] is not None]
            counts, _, place, total = _added(members)
            for r in heard:
                total[_unpack(r["places"], np.uint32)] = _unpack(r["totals"], np.uint64)
            yield _batch(_differing(members, counts, place, total, sum(r["kinds"] for r in heard)), _ANSWER)

    by_team = sent.repartition(parts, "team").sortWithinPartitions("team", "k", "unit")
    merged = by_team.mapInArrow(merge, "unit long, shard long, k int, hashes binary, counts binary")
    found = _totals(merged.mapInArrow(send, _MESSAGE_DDL), teams, bits + fan_bits, fan_bits, parts)
    both = sent.unionByName(found.withColumnRenamed("unit", "team"), allowMissingColumns=True)
    both = both.repartition(parts, "team").sortWithinPartitions("team", "k", "unit")
    return durable(both.mapInArrow(hand_on, _ANSWER_DDL), "lm-answers")


class Automaton:
    """States: 0 is the root, 1 + code a word, then the longer histories by
    order.  Arcs are kept by state and word."""

    def __init__(self, block: Block, counts: dict[int, np.ndarray], n_total: int, n_kinds: int):
        n, top = block.n, block.top
        self.width = n + 2
        c = {}
        for k in range(1, top + 1):
            c[k] = np.empty(len(counts[k]), np.float64)
            c[k][block.order[k]] = counts[k]
        chance = {1: (c[1] + 0.5) / (n_total + 0.5 * (n_kinds + 1))}
        self.count = c[1][:n + 1]
        self.root = np.log10(chance[1][:n + 1])
        sizes = [len(c[k]) for k in range(1, top)]
        state = dict(zip(range(1, top), np.cumsum([1, *sizes])[:-1].tolist(), strict=True))    # of the code 0
        self.fail, self.back = np.zeros(1 + sum(sizes)), np.zeros(1 + sum(sizes), np.int64)
        # The state after an n-gram: the longest history that it ends in and training has.
        after = {1: np.where(c[1] > 0, 1 + np.arange(n + 2), 0) if top > 1 else np.zeros(n + 2, np.int64)}
        arcs, weights, targets = [], [], []
        for k in range(2, top + 1):
            history, word = block.parent[k], block.last[k]
            keep = KAPPA + ALPHA * c[k - 1]
            self.fail[state[k - 1]:state[k - 1] + len(keep)] = np.log10(keep / (c[k - 1] + keep))
            if k > 2:
                self.back[state[k - 1]:state[k - 1] + len(keep)] = state[k - 2] + block.suffix[k - 1]
            chance[k] = ((c[k] + keep[history] * chance[k - 1][block.suffix[k]]) / (c[k - 1] + keep)[history])
            after[k] = after[k - 1][block.suffix[k]]
            seen = c[k] > 0
            if k < top:
                after[k] = np.where(seen, state[k] + np.arange(len(c[k])), after[k])
            arcs.append((state[k - 1] + history[seen]) * self.width + word[seen])    # ascending, as n-grams are
            weights.append(np.log10(chance[k][seen]))
            targets.append(after[k][seen])
        self.arcs = np.concatenate([np.empty(0, np.int64), *arcs])
        self.weights = np.concatenate([np.empty(0), *weights])
        self.targets = np.concatenate([np.empty(0, np.int64), *targets])
        self.goto = after[1]
        self.start = n + 2 if top > 1 else 0
        self.steps = top - 1
        self.reached = after[1][block.word]                  # the state after each token, for texts read in pieces
        for k in range(2, top):
            code = block.code[k]
            self.reached = np.where(code >= 0, after[k][code], self.reached)

    def read(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of reading a word in each state, and the states after it:
        failure arcs are followed up to a state with an arc for the word."""
        weight, goto = np.zeros(len(word)), np.zeros(len(word), np.int64)
        open_at, now = np.arange(len(word)), np.array(state, np.int64)
        for _ in range(self.steps):
            if not len(open_at):
                return weight, goto
            key = now * self.width + word[open_at]
            at = np.minimum(np.searchsorted(self.arcs, key), max(0, len(self.arcs) - 1))
            found = (self.arcs[at] == key) if len(self.arcs) else np.zeros(len(key), bool)
            weight[open_at[found]] += self.weights[at[found]]
            goto[open_at[found]] = self.targets[at[found]]
            open_at, now = open_at[~found], now[~found]
            weight[open_at] += self.fail[now]
            now = self.back[now]
        weight[open_at] += self.root[word[open_at]]
        goto[open_at] = self.goto[word[open_at]]
        return weight, goto

    def traverse(self, word: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log10 probability of each text, all texts in step.  A long text goes
        in pieces: the state at a piece's beginning follows from the words before."""
        parts = -(-sizes // STRIDE)
        text = np.repeat(np.arange(len(sizes)), parts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        at = first[text] + within * STRIDE
        length = np.minimum(STRIDE, sizes[text] - within * STRIDE)
        order = np.argsort(-length, kind="stable")
        text, at, length, within = text[order], at[order], length[order], within[order]
        state = np.where(within == 0, self.start, self.reached[np.maximum(at - 1, 0)])
        score = np.zeros(len(text))
        for step in range(int(length[0]) if len(length) else 0):
            alive = int(np.searchsorted(-length, -step, side="left"))      # pieces longer than step
            weight, state[:alive] = self.read(state[:alive], word[at[:alive] + step])
            score[:alive] += weight
        return np.bincount(text, score, minlength=len(sizes))


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES, order: int = ORDER, fan_bits: int = FAN_BITS) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) of
    each row of ``docs`` (doc_id, text, train), the model of ``order`` words
    learnt from the rows where ``train`` holds (null: not).  Null texts are
    empty: the end alone.  Repeated rows count and are scored each; other
    columns are not used."""
    if order < 1 or fan_bits < 1:
        raise ValueError("order and fan_bits must be at least 1")
    packed = durable(blocks(docs, block_bytes), "lm-blocks")
    n_blocks = packed.count()
    # A task answers or scores a few blocks' worth, however many there are.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_blocks // 4)
    bits = min(max(0, n_blocks - 1).bit_length(), fan_bits)
    answers = _totals(_requests(packed, bits, order), n_blocks, bits, fan_bits, parts)
    trained = F.aggregate(F.zip_with("train", "sizes", lambda t, s: F.when(t, s + 1).otherwise(0)),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    n_total = packed.agg(F.sum(trained)).first()[0] or 0
    n_kinds = answers.where("k = 1").agg(F.sum("kinds")).first()[0] or 0
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's answers come first, then the block itself."""
        found: dict[int, list] = {k: [] for k in range(1, order + 1)}
        for b in batches:
            id_kind = b.schema.field("ids").type.value_type
            for r in b.to_pylist():
                if r["codes"] is None:
                    found[r["k"]].append((r["places"], r["totals"]))
                    continue
                own = Block(r["train"], r["sizes"], r["vocabulary"], r["codes"], order)
                counts = {}
                for k in found:
                    counts[k] = own.counts[k].astype(np.float64)
                    for places, totals in found[k]:
                        counts[k][_unpack(places, np.uint32)] = _unpack(totals, np.uint64)
                found = {k: [] for k in found}
                machine = Automaton(own, counts, n_total, n_kinds)
                docs_of = np.repeat(np.arange(len(own.sizes)), own.sizes)
                base = np.bincount(docs_of, machine.root[own.word], minlength=len(own.sizes))
                known = np.bincount(docs_of, machine.count[own.word] > 0, minlength=len(own.sizes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], id_kind), pa.array(r["train"], pa.bool_()), pa.array(own.sizes), pa.array(known),
                     pa.array(np.full(len(own.sizes), n_total)), pa.array(base),
                     pa.array(machine.traverse(own.word, own.first, own.sizes))],
                    names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    rows = packed.unionByName(answers.select(F.col("unit").alias("block"), "k", "places", "totals"), allowMissingColumns=True)
    rows = rows.repartition(parts, "block").sortWithinPartitions("block", F.col("codes").isNotNull())
    return rows.mapInArrow(run, f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, "
                                "base_score double, score double")
