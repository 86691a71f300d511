"""Language identification by compression.

Each language gets a zstandard raw-content dictionary made of its most common
words.  A text is cut into chunks, each is compressed with every dictionary,
and the language with the smallest total wins; where the runner-up is nearly
as small the answer is marked as rejected.
"""

from __future__ import annotations

from collections import Counter

import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, texts

ROWS_PER_LANGUAGE = 400      # sample a dictionary is made of: rows ...
CHARS_PER_ROW = 4000         # ... and characters of each
BIN_BITS = 12                # leading bits of a hash by which rows are counted first
DICTIONARY_BYTES = 32 << 10
CHUNK_BYTES = 4096
LEVEL, SHORT_LEVEL = 6, 19
NARROW = 0.01                # margin below which a prediction is rejected
WIDE = 0.10                  # margin that counts as certain
UNKNOWN = "und"


def fit(rows: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> dict[str, bytes]:
    """Dictionaries by language from (text, lang) rows.

    The sample is bounded: the ``rows_per_language`` distinct texts of each
    language with the lowest hashes, ``CHARS_PER_ROW`` characters of each.
    Lines found under more than one language are left out, and a line counts
    once.  The number of languages is that of the labels.  Null texts or
    labels are skipped."""
    d = (rows.where("lang IS NOT NULL AND length(text) > 0")
         .select("lang", F.substring("text", 1, CHARS_PER_ROW).alias("text"))
         .withColumn("h", F.xxhash64("text")))
    # Hashes are chosen before any text moves: bins of the hash are counted, the
    # bins up to the one that completes a language's sample are ranked.
    hashes = d.select("lang", "h").distinct().withColumn("bin", F.shiftright("h", 64 - BIN_BITS))
    upto = F.sum("c").over(Window.partitionBy("lang").orderBy("bin"))
    cuts = (hashes.groupBy("lang", "bin").agg(F.count("*").alias("c"))
            .withColumn("before", upto - F.col("c")).where(F.col("before") < rows_per_language)
            .groupBy("lang").agg(F.max("bin").alias("cut")))
    chosen = (hashes.join(F.broadcast(cuts), "lang").where("bin <= cut")
              .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
              .where(F.col("r") <= rows_per_language).select("lang", "h"))
    # Broadcast: one row, and at most rows_per_language rows, of a language; the
    # sample itself, which is larger, goes to the driver.
    sample = (d.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
              .select("lang", "text").collect())
    lines: dict[str, set[str]] = {}
    for lang, text in sample:
        lines.setdefault(lang, set()).update(text.lower().split("\n"))
    shared = Counter(line for own in lines.values() for line in own)
    out = {}
    for lang, own in lines.items():
        count = Counter()
        for line in own:
            if shared[line] == 1:
                count.update(set(line.split()))
        words, size = [], 0
        for word, _ in sorted(count.items(), key=lambda x: (-x[1], x[0])):
            size += len(word.encode()) + 1
            if size > DICTIONARY_BYTES:
                break
            words.append(word)
        # What stands last is nearest to the text and cheapest to refer to.
        out[lang] = (" ".join(reversed(words)) + " ").encode()
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.by_level = {level: [self._compressor(dictionaries[k], level) for k in self.langs]
                         for level in (LEVEL, SHORT_LEVEL)}

    @staticmethod
    def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
        if len(content) < 8:          # too little for a dictionary
            return zstandard.ZstdCompressor(level=level, write_content_size=False)
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False)

    def sizes(self, text: str, level: int) -> list[int]:
        totals = [0] * len(self.langs)
        for at in range(0, len(text), CHUNK_BYTES):
            # Characters, not bytes: the text is never encoded as a whole.
            chunk = text[at:at + CHUNK_BYTES].lower().encode()
            for i, c in enumerate(self.by_level[level]):
                totals[i] += len(c.compress(chunk))
        return totals

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, rejected."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        totals = self.sizes(text, LEVEL)
        if len(text) <= CHUNK_BYTES and sorted(totals)[0] == sorted(totals)[1]:
            totals = self.sizes(text, SHORT_LEVEL)
        (best, i), (second, _) = sorted((n, i) for i, n in enumerate(totals))[:2]
        margin = (second - best) / second
        return self.langs[i], min(1.0, margin / WIDE), margin < NARROW


def predict(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of each whole text.  A null text
    or one without a letter is ``und``; repeated rows give repeated rows."""
    state: dict[str, Classifier] = {}

    def run(b):
        model = state.get("m") or state.setdefault("m", Classifier(dictionaries))
        found = [model.predict(t) for t in texts(b)]
        return {"doc_id": b.column("doc_id"), "lang_pred": [x[0] for x in found],
                "score": [x[1] for x in found], "rejected": [x[2] for x in found]}

    return map_rows(docs.select("doc_id", "text"),
                    f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, "
                    "rejected boolean", run)
