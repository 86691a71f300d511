"""BPE, quality rules, PII, language ID, WARC and fingerprints against brute force."""

import base64
import hashlib
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import edge  # noqa: E402

from panelcast.llm import bpe, fingerprints, language_id, pii, quality, warc  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _tiktoken():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark):
    docs = edge.documents(spark)
    tk = _tiktoken()
    want = sorted(((r.doc_id, tk.encode_ordinary(r.text or "")) for r in docs.collect()), key=repr)
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert edge.rows(ids) == want
    back = bpe.decode(ids, RANKS, public_tokenizers.PATTERN)
    assert edge.rows(back) == sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=repr)
    trip = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert edge.rows(trip) == sorted(
        ((r.doc_id, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
          hashlib.sha256((r.text or "").encode()).hexdigest())
         for r in docs.collect() for x in [tk.encode_ordinary(r.text or "")]), key=repr)
    assert bpe.round_trip(edge.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_random_unicode_and_long_pretokens():
    tk, enc = _tiktoken(), bpe.encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    pool = [9, 10, 13, 32, 32, 32, 0x1C, 0x85, 0xA0, 0x180E, 0x200B, 0x3000, 0x27]
    samples = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xD7FF), rng.choice(pool)]))
                       for _ in range(40)) for _ in range(500)] + ["a" * 20_000, "xyzé" * 8_000]
    for s in samples:
        got = np.frombuffer(b"".join(enc.portions(s)), "<u4").tolist()
        assert got == tk.encode_ordinary(s), ascii(s[:60])


def test_bpe_portions_of_very_long_texts(monkeypatch):
    enc = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    text = "some words, and  more\n" * 300
    whole = b"".join(enc.portions(text))
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "PORTION", 7)
    assert b"".join(enc.portions(text)) == whole


def _base(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    hit = set()
    for i, g in enumerate(zip(ws, ws[1:], ws[2:])):
        if grams[g] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(hit), len(ws) < 50 or 100 * len(hit) > 50 * len(ws))


def test_quality_base_columns(spark):
    docs = edge.documents(spark)
    got = edge.rows(quality.line_frequency(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed")
    assert got == sorted(((r.doc_id, *_base(r.text)) for r in docs.collect()), key=repr)
    assert quality.line_frequency(edge.empty(spark)).count() == 0


def test_quality_boilerplate_by_host(spark):
    rng = random.Random(1)
    menu = edge.words(rng, 60)
    rows = [(i, f"{menu}\n{edge.words(rng, 20)}", "a") for i in range(30)]                # depleted
    rows += [(100 + i, f"{menu.upper()}\n" + edge.words(rng, 300), "a") for i in range(5)]  # enough is left
    rows += [(200 + i, f"{menu}\n{edge.words(rng, 20)}", "b") for i in range(5)]          # rare on its host
    copy = edge.words(rng, 100)
    rows += [(300 + i, copy, "a") for i in range(50)]                                     # one text, many copies
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in quality.line_frequency(docs).collect()}
    assert [i for i in kept if not kept[i]] == list(range(30)) or sorted(i for i in kept if not kept[i]) == list(range(30))
    clean = {r.doc_id: r.text for r in quality.clean(docs).collect()}
    assert not set(range(30)) & set(clean) and quality.clean(edge.documents(spark)).columns == edge.documents(spark).columns
    assert clean[100] == rows[30][1].split("\n")[1] and clean[200] == rows[35][1] and clean[300] == copy


def _brute_spans(text):
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                           r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
                           r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans_equal_the_patterns():
    rng = random.Random(9)
    for _ in range(4000):
        t = "".join(rng.choice("ab.@@-+%1234567890  ()é_") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == _brute_spans(t), t
    assert pii.base_spans("a" * 300_000 + "1" * 300_000) == []          # linear time
    t = "mail x@y.z.com x@y.z@w.v, 1.2.3.4.5.6.7.8 0001.2.3.256 4111 1111-1111 1111 and +1 (212) 555-0100."
    assert pii.base_spans(t) == _brute_spans(t)


def test_pii_counts_are_of_their_kinds(spark):
    docs = [(1, "1.2.3.4 then 5.6.7.8 and 9.9.9.9"), (2, "call +44 20 7946 0958"), (3, "4111 1111 1111 1111 of a@b.org"), (4, None),
            (5, "a@b.org c@d.org 4111111111111111 10.0.0.1")]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        spans = _brute_spans(t or "")
        want = tuple(sum(k == n for _, k, _ in spans) for n in range(4))
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == want, t
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_pii_bootstrap_finds_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [(i, f"{edge.words(rng, 12)} reach me {'at user%d@mail.example' % i} {edge.words(rng, 5)}") for i in range(8)]
    rows += [(50 + i, f"{edge.words(rng, 9)} me at ID-77{i}-4{i}1 {edge.words(rng, 4)}") for i in range(2)]
    rows += [(80 + i, f"{edge.words(rng, 9)} version number 20{i}1-build {edge.words(rng, 4)}") for i in range(9)]
    rows += [(99, None), (98, ""), (50, rows[8][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    assert all(got[i].startswith("email:") for i in range(8))
    text = dict(rows)[50]
    s = text.index("ID-")
    assert got[50] == f"id:{s}:{s + len('ID-770-401')}"
    assert all(not got[i] for i in (80, 88, 99, 98))
    red = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert "[EMAIL]" in red[0] and "@" not in red[0] and "[ID]" in red[50] and red[99] is None
    assert pii.report(edge.empty(spark)).count() == 0
    assert pii.report(edge.documents(spark)).count() == edge.documents(spark).count()


def test_pii_discovered_instances_are_seeds(spark):
    rng = random.Random(5)
    staff = [f"ID-77{i}-4{i}1" for i in range(12)]
    rows = [(i, f"{edge.words(rng, 9)} reach me at user{i}@mail.example {edge.words(rng, 4)}") for i in range(40)]
    rows += [(100 + i, f"{edge.words(rng, 9)} reach me at {x} {edge.words(rng, 4)}") for i, x in enumerate(staff)]
    rows += [(200 + i, f"{edge.words(rng, 9)} employee no {x} {edge.words(rng, 4)}") for i, x in enumerate(staff)]
    rows += [(300, f"{edge.words(rng, 9)} employee no ZZ-9041-7 {edge.words(rng, 4)}")]
    # Few of a common context's instances are seeds: it stays out.
    rows += [(400 + i, f"{edge.words(rng, 9)} order nr {x} {edge.words(rng, 4)}")
             for i, x in enumerate(staff[:4] + [f"PN-{j}55{j}" for j in range(40)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    text = dict(rows)
    for i, x in [*((200 + i, x) for i, x in enumerate(staff)), (300, "ZZ-9041-7")]:
        s = text[i].index(x)
        assert got[i] == f"id:{s}:{s + len(x)}"
    assert not any(got[i] for i in text if i >= 400)


def test_pii_tokens_of_long_runs_and_long_context():
    def found(text):
        return [(p, text[s:e]) for p, _, _, s, e in pii._mentions(text, pii.base_spans(text))]
    run = "https://host.example/" + "a/b" * 80
    assert found(f"see page {run}?staff=ID-771-401, then") == [("page staff", "ID-771-401")]
    assert found(f"see page {run}?staff=ID-771-401&name=x") == [("page staff", "ID-771-401")]
    assert found(f"see page {run}?id=PN-55-1!") == [("page id", "PN-55-1")]
    assert found("ab" * 50 + " " + "cd" * 50 + " ID-771-401") == [("ab" * 50 + " " + "cd" * 50, "ID-771-401")]
    assert found("a staff no ID-771-401.") == [("staff no", "ID-771-401")]
    assert found("me at user=ID-771-401;") == [("at user=", "ID-771-401")]
    assert found("x y " + "k=AB1234&" * 50_000) == [("y k", "AB1234")] * 50_000        # linear time
    assert found("x y " + "\u6587" * 150 + "\uff0c\u7f16\u53f7ID-771-401" + "\u6587" * 150) == [("y \u7f16\u53f7", "ID-771-401")]
    assert found("x" * 300_000 + "11") == []


def test_language_id_held_out(spark):
    src = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(src.where("doc_id % 4 != 2").select("text", "lang"))
    out = language_id.predict(src.where("doc_id % 4 = 2"), model).join(src.select("doc_id", "lang"), "doc_id")
    rows = out.collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    odd = {(r.doc_id, r.lang_pred) for r in language_id.predict(edge.documents(spark), model).collect()}
    assert {p for _, p in odd} <= set(model) | {"und"}
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "123 -"), (4, "der und die")], "doc_id long, text string")
    assert [r.lang_pred for r in language_id.predict(blank, model).orderBy("doc_id").collect()] == ["und"] * 3 + ["de"]
    assert language_id.fit(edge.empty(spark).select("text", "lang")) == {}


def test_warc_round_trip(spark):
    rng = random.Random(4)
    big = "".join(rng.choice("ab\r\n é") for _ in range(5000))
    rows = [(1, "u", "<p>one"), (2, "u", big), (3, None, big), (5, "u\r\nx", "a\r\n\r\nWARC/1.1\r\nb: c\r\n\r\n"), (4, "u", None),
            (6, "u", ""), (7, "u", big), (8, "u", "\r"), (9, "u", "x" * 64), (10, "u", "<p>one"), (None, "u", "<p>one"),
            (11, "u", "\r\n"), (12, "u", "y" * 128 + "\r"), (12, "u", "y" * 128 + "\r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = warc.round_trip(pages, chunk=64).collect()
    assert all(r.digest_ok for r in got) and len(got) == len(rows)
    by = {}
    for i, _, h in rows:
        by.setdefault(h or "", []).append(-1 if i is None else i)
    for (i, _, h) in rows:
        if i == 12:
            continue
        data = (h or "").encode()
        r = next(r for r in got if r.page_id == i)
        top = max(by[h or ""])
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if i == top else ("revisit", top)), i
    assert sorted(r.record_type for r in got if r.page_id == 12) == ["response", "revisit"]
    assert warc.round_trip(spark.createDataFrame([], pages.schema)).count() == 0
    small = warc.round_trip(pages, chunk=64, min_bytes=10**6)
    assert {r.record_type for r in small.collect()} == {"response"}


def test_fingerprints(spark, monkeypatch):
    docs = edge.documents(spark)
    want = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0), reverse=True)
    monkeypatch.setattr(fingerprints, "BUCKET_BYTES", 20_000)
    out = fingerprints.compare_edited(docs).collect()
    assert len(out) == len(want)
    prints = {}
    for i, r in enumerate(want):
        t, nxt = r.text or "", want[(i + 1) % len(want)].text or ""
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        got = [x for x in out if x.doc_id == r.doc_id]
        assert any(x.n_chars == len(t) and x.edited_sha256 == hashlib.sha256(e.encode()).hexdigest() for x in got), r.doc_id
        for x in got:
            assert prints.setdefault(t, x.fingerprint) == x.fingerprint
            assert 0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1
    alone = fingerprints.fingerprint(docs)
    assert all(prints[dict((r.doc_id, r.text or "") for r in want)[r.doc_id]] == r.fingerprint for r in alone.collect())
    assert fingerprints.compare_edited(edge.empty(spark)).count() == 0


def test_parsing_is_locally_consistent():
    rng = random.Random(8)
    core = edge.words(rng, 600)
    a, b, c = (fingerprints.sketches([x], 10**6)[0] for x in (core, "zz top " + core + " end", edge.words(rng, 600)))
    assert len(np.intersect1d(a, b)) > 0.97 * len(a)
    assert fingerprints.likeness(a, c, 10**6) < 0.1
    batch = fingerprints.sketches([core, "", "q", core[:50], core])
    assert [x.tolist() for x in batch] == [fingerprints.sketches([x])[0].tolist() for x in (core, "", "q", core[:50], core)]


def test_language_sample_is_that_of_the_lowest_hashes(spark):
    """Copies count once, null labels and empty texts not at all, whatever the sizes."""
    rows = [(f"w{i} x{i % 7} line{i}", "a") for i in range(300)] + [("w0 x0 line0", "a")] * 100
    rows += [(f"v{i} y{i % 5}", "b") for i in range(9)] + [("z z", None), (None, "a"), ("", "b")]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("h", F.xxhash64("text"))
    every = sorted({(r["lang"], r["h"], r["text"]) for r in docs.collect() if r["lang"] and r["text"]})
    for n in (1, 20, 1000):
        chosen = [r[2::-2] for lang in "ab" for r in [x for x in every if x[0] == lang][:n]]
        wanted = language_id.fit(spark.createDataFrame(chosen, "text string, lang string"), 10 ** 6)
        assert language_id.fit(docs, n) == wanted and set(wanted) == {"a", "b"}
