"""License scans: an exact set-similarity join of text blocks with license
templates.

Templates are sets of words.  A text is cut into overlapping blocks of words,
twice as long as the templates of a size class and shifted by that size, so
any run of words of a template's length lies within a block.  A block matches
if it holds at least the share ``threshold`` of the template's words.  Words
are ordered by the number of documents that hold them, rarest first; only the
first words of a template (its prefix) can be the first shared one, so blocks
meet templates under prefix words, and filters on length and on the positions
of the shared word leave few pairs to compare in full.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, texts

# Words: ASCII letters (lower-cased) and digits, and all beyond ASCII.
WORD_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Phrases of the base rule.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Sentences of public license notices.
TEMPLATES = (
    ("mit", "released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written permission"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("epl", "made available under the terms of the Eclipse Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
             "and to alter it and redistribute it freely"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc0", "the person who associated CC0 with this work has waived all copyright and related or neighboring rights"),
)
THRESHOLD = 0.85
CLASSES = (8, 16, 32)    # longest templates of a size class, in words; longer ones are split


def words_of(text: str) -> list[bytes]:
    return _WORDS.findall(text.encode(errors="surrogatepass").translate(_LOWER))


def template_sets(templates: Sequence[tuple[str, str]] = TEMPLATES) -> list[tuple[str, int, list[bytes]]]:
    """(label, size class, distinct words) of each template; those of more than
    32 words are split into equal parts that match on their own."""
    out = []
    for label, text in templates:
        w = words_of(text)
        parts = math.ceil(len(w) / CLASSES[-1])
        for k in range(parts):
            part = w[k * len(w) // parts:(k + 1) * len(w) // parts]
            out.append((label, next(c for c in CLASSES if len(part) <= c), list(dict.fromkeys(part))))
    return out


def need(size: int, threshold: float) -> int:
    """Words of a template of ``size`` that a block must hold."""
    return max(1, math.ceil(round(threshold * size, 9)))


def _base(pos: np.ndarray, tok: np.ndarray, phrases: list[tuple[np.ndarray, str]]) -> tuple[list[int], set[str]]:
    starts, labels = [], set()
    for ids, label in phrases:
        m = len(ids)
        if len(tok) < m:
            continue
        ok = pos[m - 1:] - pos[:len(pos) - m + 1] == m - 1
        for k in range(m):
            ok &= tok[k:len(tok) - m + 1 + k] == ids[k]
        at = pos[:len(ok)][ok]
        if len(at):
            starts += at.tolist()
            labels.add(label)
    return starts, labels


def _mentions(docs: DataFrame, vocab: dict[bytes, int], phrases: Sequence[tuple[str, str]]) -> DataFrame:
    """Per row of ``docs`` the base columns and the places of the words that
    templates or phrases hold."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    coded = [(np.array([vocab[w] for w in words_of(p)]), label) for p, label in phrases]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[] for _ in range(7)]
            for t in texts(b):
                hits = [vocab.get(w, -1) for w in words_of(t)]
                every = np.array(hits, np.int32)
                pos = np.flatnonzero(every >= 0).astype(np.int32)
                tok = every[pos].astype(np.int16)
                starts, labels = _base(pos, tok, coded)
                row = (len(hits), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels),
                       pos.tobytes(), tok.tobytes())
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            types = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("rid"), *(pa.array(c, k) for c, k in zip(cols, types, strict=True))],
                names=["doc_id", "rid", "n_words", "n_base", "first_word", "last_word", "base", "pos", "tok"])

    d = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))
    return d.mapInArrow(run, f"doc_id {kind}, rid long, n_words long, n_base long, first_word long, last_word long, "
                             "base array<string>, pos binary, tok binary")


def _frequencies(found: DataFrame, size: int) -> np.ndarray:
    """Documents with each word of the vocabulary: partial counts by task,
    one row for each word at the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for t in b.column("tok").to_pylist():
                total[np.unique(np.frombuffer(t, np.int16))] += 1
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k])], names=["k", "n"])

    out = np.zeros(size, np.int64)
    for r in found.select("tok").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


def _blocks(found: DataFrame, rank: np.ndarray, prefixes: dict[int, np.ndarray]) -> DataFrame:
    """(rid, c, ranks): the sorted ranks of each block that holds a prefix word
    of its size class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rids, kinds, sets = [], [], []
            for rid, n, p, t in zip(b.column("rid").to_pylist(), b.column("n_words").to_pylist(),
                                    b.column("pos").to_pylist(), b.column("tok").to_pylist(), strict=True):
                pos, r = np.frombuffer(p, np.int32), rank[np.frombuffer(t, np.int16)]
                for c, rare in prefixes.items():
                    k = pos[rare[r]] // c
                    if not len(k):
                        continue
                    k = np.unique(np.concatenate([k, k - 1]))
                    k = k[(k >= 0) & (k <= max(0, -(-n // c) - 2))]
                    for a, e in zip(np.searchsorted(pos, k * c).tolist(), np.searchsorted(pos, k * c + 2 * c).tolist(),
                                    strict=True):
                        rids.append(rid)
                        kinds.append(c)
                        sets.append(np.unique(r[a:e]).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(kinds, pa.int32()),
                                              pa.array(sets, pa.list_(pa.int32()))], names=["rid", "c", "ranks"])

    return found.select("rid", "n_words", "pos", "tok").mapInArrow(run, "rid long, c int, ranks array<int>")


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) of each row of ``docs`` (doc_id and text are used; other columns,
    of whatever names, are not).

    Null texts are empty: no words, no labels, score 0.  Repeated rows give
    repeated rows.  ``score`` is the largest containment of a matching
    template, 1 with a base phrase and 0 without a match.  ``templates`` are a
    parameter of at most some thousands of words, so their index is broadcast
    and the counts of their words are held on the driver.  A label whose
    template is part of a longer one's text is found beside it."""
    spark = docs.sparkSession
    sets = template_sets(templates)
    vocab = {w: i for i, w in enumerate(dict.fromkeys(
        [w for _, _, ws in sets for w in ws] + [w for p, _ in phrases for w in words_of(p)]))}
    if len(vocab) >= 1 << 15:
        raise ValueError("templates of more than 32,767 distinct words")
    found = durable(_mentions(docs, vocab, phrases), "licenses")

    order = np.lexsort((np.arange(len(vocab)), _frequencies(found, len(vocab))))
    rank = np.empty(len(vocab), np.int32)
    rank[order] = np.arange(len(vocab), dtype=np.int32)
    index, prefixes = [], {}
    for label, c, ws in sets:
        r = sorted(rank[vocab[w]].item() for w in ws)
        least = need(len(r), threshold)
        prefix = r[:len(r) - least + 1]
        prefixes.setdefault(c, np.zeros(len(vocab), bool))[prefix] = True
        index += [(x, c, i, label, r, least) for i, x in enumerate(prefix)]
    index = spark.createDataFrame(index, "r int, c int, i int, label string, words array<int>, least int")

    n, size = F.size("ranks"), F.size("words")
    pairs = (_blocks(found, rank, prefixes).select("rid", "c", "ranks", F.posexplode("ranks").alias("j", "r"))
             .join(F.broadcast(index), ["r", "c"])
             .where(n >= F.col("least"))
             .where(F.least("i", "j") + 1 + F.least(size - F.col("i"), n - F.col("j")) - 1 >= F.col("least"))
             .withColumn("both", F.size(F.array_intersect("ranks", "words"))).where("both >= least"))
    labels = (pairs.groupBy("rid", "label").agg(F.max(F.col("both") / size).alias("s"))
              .groupBy("rid").agg(F.collect_set("label").alias("more"), F.max("s").alias("s")))
    out = found.drop("pos", "tok").join(labels, "rid", "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.coalesce("s", F.lit(0.0))).alias("score"))


def scan_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
             threshold: float = THRESHOLD) -> str:
    """``scan`` of the table documents as SQL: every block against every
    template of its size class."""
    def listed(ws):
        return "[" + ", ".join(f"'{w.decode()}'" for w in ws) + "]"
    rows = ", ".join(f"('{label}', {c}, {listed(ws)}, {need(len(ws), threshold)})"
                     for label, c, ws in template_sets(templates))
    said = ", ".join(f"('{label}', {listed(words_of(p))})" for p, label in phrases)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH template(label, c, words, least) AS (VALUES {rows}), phrase(label, words) AS (VALUES {said}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD_RE}') AS w FROM documents),
block AS (SELECT rid, c, list_distinct(w[s + 1:s + 2 * c]) AS words
          FROM (SELECT rid, w, c, unnest(range(0, len(w), c)) AS s FROM d, (SELECT DISTINCT c FROM template))),
hit AS (SELECT rid, label, max(len(list_intersect(b.words, t.words)) / len(t.words)) AS s
        FROM block b JOIN template t USING (c) WHERE len(list_intersect(b.words, t.words)) >= least GROUP BY ALL),
place AS (SELECT rid, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(words)] = words)) AS start
          FROM d, phrase WHERE list_has_all(w, words)),
base AS (SELECT rid, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM place GROUP BY rid),
named AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE own) AS base_labels,
                 string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT rid, label, true AS own FROM place UNION ALL SELECT rid, label, false FROM hit) GROUP BY rid),
best AS (SELECT rid, max(s) AS s FROM hit GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE 0 END, coalesce(s, 0)) AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN named USING (rid) LEFT JOIN best USING (rid)"""
