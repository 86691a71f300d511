import random
import re

from panelcast.llm import licenses as L

from .edge import documents, empty, rows

WORDS = re.compile(L.WORD_RE)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text, templates, phrases, threshold):
    w = WORDS.findall(lower(text))
    places, base, labels, score = [], set(), set(), 0.0
    for p, label in phrases:
        pw = WORDS.findall(lower(p))
        at = [i for i in range(len(w)) if w[i:i + len(pw)] == pw]
        places += at
        if at:
            base.add(label)
    for label, c, ws in L.template_sets(templates):
        ws = {x.decode() for x in ws}
        for s in range(0, len(w), c):
            both = len(ws & set(w[s:s + 2 * c]))
            if both >= L.need(len(ws), threshold):
                labels.add(label)
                score = max(score, both / len(ws))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), max(score, float(bool(places))))


COLS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def check(spark, table, **options):
    got = L.scan(table, **options)
    assert got.columns == COLS
    args = [options.get(k, d) for k, d in (("templates", L.TEMPLATES), ("phrases", L.PHRASES), ("threshold", L.THRESHOLD))]
    want = [(r["doc_id"], *brute(r["text"], *args)) for r in table.collect()]
    assert rows(got) == sorted(want, key=repr)
    return got


def test_edge_cases(spark):
    check(spark, documents(spark))
    assert L.scan(empty(spark)).count() == 0


def test_notices_edited_and_split(spark):
    """Whole and edited notices at all offsets, case, marks, base phrases, look-alikes."""
    rng = random.Random(3)
    noise = ["the", "software", "use", "terms", "copy", "ab", "xyz", "żółć", "9", "public", "license", "under", "mit"]
    texts = []
    for k in range(150):
        notice = rng.choice(L.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 4)):
            notice[rng.randrange(len(notice))] = rng.choice(noise)
        texts.append(" ".join(rng.choices(noise, k=k)) + rng.choice(["\n", " ", "...", "\x00"]) + " ".join(notice).upper())
    texts += ["Under The MIT license; Apache  license, VERSION 2. CC-BY-NC", "under the mit license", "under the mit licenses",
              "under the mit license " * 3, "cc by-nc" * 3, "İ under the mit license"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in check(spark, d).collect()}
    assert got[150]["labels"].split(",")[:3] == ["apache-2", "cc-by-nc", "mit"]
    assert got[153]["n_base"] == 3 and (got[153]["first_word"], got[153]["last_word"]) == (0, 8)


def test_random_templates(spark):
    """Prefix, length and positional filters lose nothing: random sets over a
    skewed vocabulary, several thresholds."""
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    pick = lambda n: " ".join(rng.choices(vocab, weights, k=n))
    templates = [(f"t{i}", pick(rng.choice([1, 3, 7, 9, 20, 31, 32, 33, 90]))) for i in range(25)]
    texts = [pick(rng.randint(0, 300)) for _ in range(40)]
    for i, (_, t) in enumerate(templates):
        texts.append(pick(i) + " " + t + " " + pick(30 - i))
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for threshold in (0.5, 0.8, 1.0):
        check(spark, d, templates=templates, threshold=threshold)


def test_keys_of_any_type_and_repeats(spark):
    d = spark.createDataFrame([("a", "under the mit license")] * 3 + [(None, None)], "doc_id string, text string")
    assert rows(L.scan(d), "doc_id", "n_base", "labels") == [("a", 1, "mit")] * 3 + [(None, 0, "")]
