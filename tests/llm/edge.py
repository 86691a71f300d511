"""Small tables with the awkward cases every operator must handle."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, ids string, bucket int"


def words(rng, n, size=400):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) + rng.choice(["", "", "", ",", "."])
                    for _ in range(n))


def documents(spark, rows=40, seed=5):
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 400)) for _ in range(rows)]
    texts += [None, "", " ", "\n\n", "a", "a a a a", "Zażółć gęślą jaźń \U0001f600\U0001f600", "x" * 30_000,
              "ab " * 5_000, words(rng, 20_000), texts[0], texts[0], texts[1] + " tail", "line one\nline one\n\nline one",
              "\x1c\x85  mixed\tspaces \r\n  here", "# * $ % & | < > 12 34"]
    out = [(i, t, ["en", "fr", None][i % 3], [None, "src0", "src0", "src1"][i % 4], None, True, "x", i)
           for i, t in enumerate(texts)]
    out.append(out[3])                       # a repeated row
    out.append((None, texts[2], None, None, None, None, None, None))
    return spark.createDataFrame(out, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()), key=repr)
