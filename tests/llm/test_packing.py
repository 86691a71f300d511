"""Packing: every id in exactly one piece, sequences full or powers of two."""

import os
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402

from panelcast.llm import packing  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def _check(docs, window):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(t.encode(r.text or "", add_special_tokens=False).ids + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, PATH, window=window, with_ids=True).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, copies in want.items():
        n = len(copies)
        flat = [i for _, ids, _ in sorted(pieces[doc]) for i in ids]
        assert len(flat) == sum(map(len, copies))
        if n == 1:
            assert flat == copies[0] and {p[2] for p in pieces[doc]} == {len(flat)}
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    return sequences


def test_pack(spark):
    docs = edge.documents(spark)
    _check(docs, 2048)
    _check(docs, 64)
    assert packing.pack(edge.empty(spark), PATH).count() == 0


def test_pack_of_one_repeated_length(spark):
    one = spark.createDataFrame([(i, "a b c d e f g") for i in range(100)], "doc_id long, text string")
    assert sum(len(x) > 1 for x in _check(one, 16).values()) >= 50      # pairs fill windows


def test_words_apart_equal_whole_texts():
    rng = np.random.default_rng(1)
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    words = packing._words(PATH)
    latin = [*range(32, 127), *range(0x80, 0x100), *map(ord, ".,. ,_ !?\n aA")]
    pool = [*range(32, 127), 0x41, 0x130, 0x3A3, 0x301, 0x85, 0xA0, 9, 10, 13, 0x1C, 0x2028, 0x1F600, 0xC9, 0x1E9E, 32, 32, 10]
    for _ in range(4000):
        s = "".join(chr(rng.choice(pool if rng.random() < .4 else latin)) for _ in range(25)) + "<|endoftext|>" * int(rng.integers(2))
        got = np.frombuffer(b"".join(map(words.__getitem__, packing._pieces(s))), words.dtype).tolist()
        assert got == t.encode(s, add_special_tokens=False).ids, ascii(s)


def test_least_squares_uses_no_length_too_often():
    rng = np.random.default_rng(2)
    hist = np.zeros(65, np.int64)
    hist[1:64] = rng.integers(0, 50, 63)
    combos = packing.combinations(hist, 64)
    assert (combos.sum(1) == 64).all()
    counts = packing.rounded(hist, combos, packing.solve(hist.astype(float), combos))
    used = np.bincount(combos[combos > 0], np.repeat(counts, (combos > 0).sum(1)), minlength=65)
    assert (used <= hist).all() and counts.sum() * 64 > 0.5 * (hist * np.arange(65)).sum()
    assert len(packing.solve(hist * 0.0, combos[:0])) == 0


def test_every_combination_is_offered():
    hist = np.ones(2048, np.int64)
    hist[0] = 0
    combos = packing.combinations(hist, 2048)
    triples = {tuple(x) for x in combos.tolist() if x[2]}
    assert triples == {(2048 - b - c, b, c) for b in range(1, 1024) for c in range(1, b + 1) if 2048 - b - c >= b}
    counts = packing.rounded(hist, combos, packing.solve(hist, combos))
    used = np.bincount(combos.ravel(), np.repeat(counts, 3), minlength=2048)[1:]
    assert (used <= hist[1:]).all()
