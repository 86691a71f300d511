"""Document quality rules with cross-document line frequency.

Lines are normalised and hashed; for each host the number of distinct
documents with a line is counted, lines above the limits are boilerplate and
go, and documents that keep too little are rejected.  DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, durable, quoted, unbundled

MIN_DOCS = 20            # a line is boilerplate in more distinct documents of a host than this ...
MIN_SHARE = 0.01         # ... and than this share of the host's distinct documents
KEEP_SHARE = 0.5         # a document is depleted when lines with less than this share of its characters are left
MIN_WORDS = 50
_POS = 28                # bits of a word position in a sort key
_MASK = (1 << _POS) - 1


def _word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def _line_hash(line: Column) -> Column:
    """Hash of a line in lower case, numbers as 0, white space as one blank."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), SPACE + "+", " ")
    return F.xxhash64(F.trim(plain))


def _twins(keys: Column) -> Column:
    """Positions (low bits) of sorted keys whose high bits equal a neighbour's."""
    same = lambda x, y: F.shiftright(x, _POS) == F.shiftright(y, _POS)
    near = lambda x, i: (F.coalesce(same(x, F.get(keys, i + 1)), F.lit(False))
                         | ((i > 0) & F.coalesce(same(x, F.get(keys, i - 1)), F.lit(False))))
    return F.transform(F.filter(keys, near), lambda x: x.bitwiseAND(F.lit(_MASK)))


def base_stats(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and base_failed of the column text (null: no words).

    Windows of three words are compared by a 64-bit hash: its high and its
    low 36 bits, each packed with the position, are sorted as plain numbers,
    and a window is repeated if it has a twin in both orders."""
    text = F.coalesce("text", F.lit(""))
    d = docs.withColumn("_w", _word_array(text)).withColumn(
        "_l", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)))
    n = F.size("_w")
    w = F.col("_w")
    d = d.withColumn("_h", F.when(n >= 4, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))
    d = d.withColumn("_a", F.sort_array(F.transform("_h", lambda x, i: x.bitwiseAND(F.lit(~_MASK)).bitwiseOR(i.cast("long")))))
    d = d.withColumn("_pa", _twins(F.col("_a")))
    d = d.withColumn("_b", F.when(F.size("_pa") > 0, F.sort_array(F.transform(
        "_h", lambda x, i: F.shiftleft(x, _POS).bitwiseOR(i.cast("long"))))))
    d = d.withColumn("_p", F.when(F.size("_pa") > 0, F.sort_array(F.array_intersect("_pa", _twins(F.col("_b"))))))
    p = F.col("_p")
    covered = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    d = d.select(
        *docs.columns, "_l", F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _judged(docs: DataFrame, host: str, min_docs: int, min_share: float, keep_share: float, clean: bool) -> DataFrame:
    own = F.coalesce(F.col(host).cast("string"), F.lit("\x00")).alias("_host")
    rest = [quoted(c) for c in docs.columns if clean and c not in ("doc_id", "text")]
    d = docs.select("doc_id", "text", own, *([F.struct(*rest).alias("_rest")] if rest else []))
    d = base_stats(d)
    d = d.withColumn("_lines", F.transform("_l", lambda x: F.struct(
        _line_hash(x).alias("h"), F.length(x).alias("n")))).drop("_l")
    d = d.withColumn("_same", F.xxhash64("text", F.length("text"))).withColumn("_rid", F.monotonically_increasing_id())
    d = durable(d if clean else d.drop("text"), "quality")

    first = d.groupBy("_host", "_same").agg(F.min("_rid").alias("_rid"))
    hosts = first.groupBy("_host").agg(F.count("*").alias("_docs"))
    lines = d.join(first.select("_rid"), "_rid", "left_semi").select(
        "_host", F.explode(F.array_distinct(F.col("_lines.h"))).alias("h"))
    limit = F.greatest(F.lit(min_docs).cast("double"), F.lit(min_share) * F.col("_docs"))
    common = (lines.groupBy("_host", "h").agg(F.count("*").alias("c")).where(F.col("c") > min_docs)
              .join(hosts, "_host").where(F.col("c") > limit).select("_host", "h"))
    gone = (d.select("_rid", "_host", F.explode("_lines").alias("x")).select("_rid", "_host", "x.h", "x.n")
            .join(common, ["_host", "h"]).groupBy("_rid")
            .agg(F.sum("n").alias("_gone"), *([F.collect_set("h").alias("_bad")] if clean else [])))
    total = F.aggregate("_lines", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    out = d.join(gone, "_rid", "left").withColumn("n_removed_chars", F.coalesce("_gone", F.lit(0)).cast("long"))
    return out.withColumn("kept", ~F.col("base_failed") & (total - F.col("n_removed_chars") >= keep_share * total))


def line_frequency(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
                   keep_share: float = KEEP_SHARE) -> DataFrame:
    """doc_id, the base columns, ``kept`` and n_removed_chars of each row of
    ``docs`` (doc_id, text and the host column are used).

    Documents of equal text count once for a host; a null host is one host; a
    null text has no lines.  A line is removed when more than
    ``max(min_docs, min_share * documents of the host)`` distinct documents of
    the host have it.  ``kept`` is false if the base rules fail or lines with
    less than ``keep_share`` of the characters remain.  Repeated rows give
    repeated rows."""
    return _judged(docs, host, min_docs, min_share, keep_share, False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_chars")


def clean(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE,
          keep_share: float = KEEP_SHARE) -> DataFrame:
    """The rows of ``docs`` that ``line_frequency`` keeps, the lines that it
    removes cut from the text."""
    out = _judged(docs, host, min_docs, min_share, keep_share, True).where("kept")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_bad", _line_hash(x))
                                 | ~x.rlike(WORD)), "\n")
    out = out.withColumn("text", F.when(F.col("_gone") > 0, left).otherwise(F.col("text")))
    return unbundled(out, docs.columns, "doc_id", "text")
