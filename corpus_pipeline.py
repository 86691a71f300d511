"""Corpus pipeline: quality rules, near duplicates, repeated passages, personal
data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.  ``run`` writes each stage's result to
the shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

import gc

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import near_dup, packing, pii, quality, repeats
from panelcast.llm.common import durable, prepare, read_table, release, scratch_owner

# Scratch tables of the stage before; its result is written when the next stage begins.
_scratch: list[str] = []


def _stage(fn):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        release(spark, _scratch)
        # Shuffle files go once the plans that wrote them are collected, on both sides.
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        with scratch_owner(_scratch):
            return fn(docs)
    run_stage.__doc__, run_stage.__name__ = fn.__doc__, fn.__name__
    return run_stage


def _sized(out: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    if "n_chars" not in out.columns:
        return out
    kind = out.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


@_stage
def quality_rules(docs: DataFrame) -> DataFrame:
    """Rejected documents go, boilerplate lines are cut from the others."""
    return _sized(quality.clean(docs))


@_stage
def near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group stays (five-word shingles, similarity 0.8)."""
    return near_dup.deduplicate(docs)


@_stage
def repeated_passages(docs: DataFrame) -> DataFrame:
    """Runs of 256-byte strings that also start elsewhere are cut if they have
    50 words or 400 bytes."""
    return _sized(repeats.remove(docs, **repeats.PASSAGE))


@_stage
def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _sized(pii.redact(docs))


@_stage
def pack(docs: DataFrame) -> DataFrame:
    """Pieces of the documents' tokens in sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("repeats", repeated_passages),
          ("pii", personal_data), ("packing", pack)]

# Connected components, personal data and tokens can't be had in SQL; the
# pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    written: list[str] = []
    for name, stage in STAGES[:-1]:
        out, before = stage(spark, docs, sf_dir), list(written)
        written.clear()
        with scratch_owner(written):
            docs = durable(out, f"stage-{name}")
        release(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
