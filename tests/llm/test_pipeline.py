"""The pipeline against a brute-force version of its stages."""

import os
import random
import re
import sys

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402
from test_near_dup import _set  # noqa: E402
from test_text_ops import _base, _brute_spans  # noqa: E402

import corpus_pipeline  # noqa: E402
from panelcast.llm import pii  # noqa: E402


def _documents(spark, path):
    rng = random.Random(12)
    footer = edge.words(rng, 12)
    passage = edge.words(rng, 120)
    texts = [edge.words(rng, rng.randint(60, 300)) for _ in range(30)]
    texts += [edge.words(rng, 200) + "\n" + footer for _ in range(30)]             # the footer goes
    texts += [footer + "\n" + edge.words(rng, 10) for _ in range(4)]                # too short
    texts += [edge.words(rng, 100) + " " + passage + " " + edge.words(rng, 90) for _ in range(3)]
    # Passages of 51 to 60 words, short and long ones; shared runs of fewer words stay.
    short = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4))) for _ in range(51))
    for shared in (short, edge.words(rng, 55), edge.words(rng, 60), edge.words(rng, 40)):
        texts += [edge.words(rng, 100) + " " + shared + " " + edge.words(rng, 90) for _ in range(3)]
    base = edge.words(rng, 300).split()
    for _ in range(5):
        base[rng.randrange(300)] = "other%d" % rng.randrange(999)
        texts.append(" ".join(base))
    texts += [texts[0], texts[1], None, "", edge.words(rng, 80) + " mail bob@example.com or 10.1.2.3 now " + edge.words(rng, 9)]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4) \
        .write.parquet(f"{path}/documents.parquet")
    return [(r[0], r[1]) for r in rows]


def _plain(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line.lower())).strip(" ")


def _brute(rows):
    seen = {}
    for t in {t for _, t in rows if t}:
        for line in {_plain(x) for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)}:
            seen[line] = seen.get(line, 0) + 1
    docs = []
    limit = max(20, .01 * len({t for _, t in rows}))
    for i, t in rows:
        if not _base(t)[-1]:
            lines = t.split("\n")
            left = [x for x in lines if seen.get(_plain(x), 0) <= limit]
            if sum(map(len, left)) >= .5 * sum(map(len, lines)):
                docs.append((i, "\n".join(left)))
    up = {i: i for i, _ in docs}

    def top(i):
        return i if up[i] == i else top(up[i])
    sets = {i: _set(t, 5) for i, t in docs}
    for i in sets:
        for j in sets:
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    docs = [(i, t) for i, t in docs if top(i) == i]
    count = {}
    data = [(i, t.encode()) for i, t in docs]
    for _, x in data:
        for k in range(len(x) - 255):
            count[x[k:k + 256]] = count.get(x[k:k + 256], 0) + 1
    out = {}
    for i, x in data:
        keep = np.ones(len(x), bool)
        for k in range(len(x) - 255):
            if count[x[k:k + 256]] > 1:
                keep[k:k + 256] = False
        for m in re.finditer(b"\x00+", bytes(keep.astype(np.uint8))):       # a run of marked bytes
            if m.end() - m.start() < 400 and len(x[m.start():m.end()].split()) < 50:
                keep[m.start():m.end()] = True
        t = bytes(np.frombuffer(x, np.uint8)[keep]).decode()
        for s, k, e in reversed(_brute_spans(t)):
            t = t[:s] + f"[{pii.KINDS[k].upper()}]" + t[e:]
        out[i] = t
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = _documents(spark, str(tmp_path))
    want = _brute(rows)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens, r.ids_crc32))
    assert set(pieces) == set(want)
    import zlib
    for i, t in want.items():
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4")
        own = sorted(pieces[i])
        assert {p[2] for p in own} == {len(ids)} and sum(p[1] for p in own) == len(ids)
        assert all(p[3] == zlib.crc32(ids[p[0]:p[0] + p[1]].tobytes()) for p in own)


def test_passages_of_over_fifty_words(spark, tmp_path):
    rng = random.Random(8)
    words = lambda n, a, b: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(a, b))) for _ in range(n))
    shared = [words(51, 3, 6), words(54, 3, 7), words(60, 5, 12)]
    few = words(30, 5, 9)
    texts = [words(120, 2, 7) + " " + p + " " + words(110, 2, 7) for p in shared for _ in range(3)]
    clean = [words(200, 2, 7) for _ in range(20)] + [words(100, 2, 7) + " " + few + " " + words(90, 2, 7) for _ in range(3)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + clean)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, docs, str(tmp_path)).collect()}
    assert len(got) == len(texts) + len(clean)
    for i, t in enumerate(texts):
        assert shared[i // 3] not in got[i] and len(got[i]) >= len(t) - len(shared[i // 3]) - 4
    assert [got[len(texts) + i] for i in range(len(clean))] == clean


def test_stages_keep_the_columns(spark, tmp_path):
    _documents(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, empty, str(tmp_path)).count() == 0
    odd = edge.documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns and out.count() > 0
