"""The corpus queries by name, over the test tables, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (bpe, chat, exact_dedup, extract, lexical, licenses, lm, mixing, near_dedup, periodic, quality, simhash,
                          warc)
from footfall.llm.oracle import ORACLE, SAYS_MARKS, TARGETS, TARGETS_OTHER
from footfall.runtime import stored

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_near_dedup(spark, d):
    return near_dedup.near_duplicates(read(spark, d, "documents"))


def op2_bpe(spark, d):
    tool = bpe.encoder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(read(spark, d, "documents"), tool).select(
        "doc_id", (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_simhash(spark, d):
    rows = simhash.with_next(read(spark, d, "documents"))
    near = simhash.neighbours(rows.where(F.col("doc_id") % 50 == 0), rows)
    rows = rows.join(near, "fingerprint", "left")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", simhash.as_hex("fingerprint").alias("fingerprint"),
        simhash.as_hex("edited").alias("edited_fingerprint"),
        simhash.likeness("fingerprint", "edited").alias("near_edited"),
        simhash.likeness("fingerprint", "next").alias("near_next"),
        F.when(F.col("doc_id") % 50 == 0, F.col("n_near")).alias("n_near"))


def op4_licenses(spark, d):
    return licenses.scan(read(spark, d, "documents"))


def op5_extract(spark, d):
    pages = read(spark, d, "pages").select("page_id", "url", extract.extracted("html").alias("text"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_warc(spark, d):
    manifest = warc.write(read(spark, d, "pages"))
    return warc.read(manifest, payloads=False).drop("payload")


def op7_mixing(spark, d):
    return mixing.slots(read(spark, d, "documents").select("doc_id", "source"), TARGETS, other=TARGETS_OTHER)


def op8_exact_dedup(spark, d):
    return exact_dedup.exact_duplicates(read(spark, d, "documents"))


def op9_quality(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, d, "labels"))
    return quality.scored(docs, model).select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op10_lm(spark, d):
    return lm.scores(read(spark, d, "documents"), held_out=quality.held_out("doc_id", 7, 2))


def op11_chat(spark, d):
    """All conversations and one more that says the template's own marks; written, then read back."""
    number = F.col("id")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), number.alias("turn"),
                                F.when(number == 0, "user").otherwise("assistant").alias("role"), F.lit(SAYS_MARKS).alias("text"))
    rows = read(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    chats = chat.formatted(rows.withColumn("parts", chat.parts_of_text("text")))
    return chat.digests(stored(chats, "chats"))


def op12_lexical_search(spark, d):
    return lexical.ranked(read(spark, d, "benchmark"), read(spark, d, "documents"))


def op13_periodic_runs(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    return periodic.run_digests(docs.withColumn("text", periodic.repeated_tail("text", "doc_id")))


QUERIES: dict[str, Query] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_bpe": op2_bpe,
    "op3_simhash": op3_simhash,
    "op4_licenses": op4_licenses,
    "op5_extract": op5_extract,
    "op6_warc": op6_warc,
    "op7_mixing": op7_mixing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality": op9_quality,
    "op10_lm": op10_lm,
    "op11_chat": op11_chat,
    "op12_lexical_search": op12_lexical_search,
    "op13_periodic_runs": op13_periodic_runs,
}
