"""A corpus pipeline: drop poor texts, exact and near copies, mix the sources, and encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage returns as Parquet to the shared
folder and reads it again as the next one's documents.  All stages but the last return the columns of ``documents``.

Files that are read again come in any order, so the order of the mix is in columns of the last stage's rows, ``mix_slot`` and
``mix_row``, and ``run`` returns the rows sorted by them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, exact_dedup, mixing, near_dedup, quality
from footfall.llm.oracle import TARGETS, TARGETS_OTHER
from footfall.runtime import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier, learned from the labelled ones of ``docs``, takes for good."""
    return quality.keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix: the order of files and of rows in them, which reading them again may change."""
    return mixing.mixed_rows(docs, TARGETS, other=TARGETS_OTHER)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's place in the mix, its ids, and whether they decode to the text; ranged and sorted by the place.

    The places follow from the rows alone, so they are those by which the stage before has ordered them.
    """
    tool = bpe.encoder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    places = mixing.slots(docs.select("doc_id", "source", "text"), TARGETS, other=TARGETS_OTHER)
    ordered = places.repartitionByRange("mix_slot", "mix_row").sortWithinPartitions("mix_slot", "mix_row")
    rows = bpe.round_trip(ordered, tool, keep=("mix_slot", "mix_row", "doc_id", "source", "text"))
    return rows.select("mix_slot", "mix_row", "doc_id", "source", (F.octet_length("packed") / 4).cast("long").alias("n_tokens"), "packed",
                       (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("decodes"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", encoding_stage),
]

# The classifier and the near duplicates are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_dir(spark, "corpus")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs.orderBy("mix_slot", "mix_row")
