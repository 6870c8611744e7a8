"""Exact duplicates by a stream with keyed state.

Texts are equal when they are the same after lower-casing A-Z.  Content is loaded into a table once, each row
with a locator and the SHA-256 of its text.  A stream reads digest, identifier and locator; its state, one
entry per digest on disk (RocksDB) and never expired, holds the largest identifier with its
locator and the number of rows.  More content can be loaded at any time: the stream goes on from its checkpoint.

A digest met more than once is a hit, and hits are checked: the whole text at the state's locator is compared with
each other text of the group.  Groups in which they differ are told apart by their texts.

Edge cases.  Null text is empty, and empty texts are equal.  Null identifiers come before all others.
Of repeated rows with the largest identifier one stays, the one with the largest locator.  Columns
of ``docs`` are kept inside one struct, so they may have any name.  No rows give no rows.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.runtime import shared_dir, stored

# State on disk; a store takes the space it needs only, since there is one per shuffle partition.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
UNTIL_NOW = {"availableNow": True}
KEEP = "keep struct<id: {id}, locator: string>"


def normal(text: str | Column) -> Column:
    """The text with A-Z in lower case; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def load(docs: DataFrame, content: str, id_col: str = "doc_id", text: str = "text", digest_bytes: int = 32) -> None:
    """Add rows to the content table: (id, locator, digest, sha256, doc).

    ``digest_bytes`` below 32 cuts the digest, so that tests can have different texts with one digest.
    """
    sha256 = F.unhex(F.sha2(normal(text).cast("binary"), 256))
    locator = F.concat(F.lit(f"{uuid.uuid4().hex}:"), F.monotonically_increasing_id().cast("string"))
    rows = docs.select(F.col(id_col).alias("id"), locator.alias("locator"), sha256.alias("sha256"),
                       F.struct(*["`" + c.replace("`", "``") + "`" for c in docs.columns]).alias("doc"))
    (rows.select("id", "locator", F.substring("sha256", 1, digest_bytes).alias("digest"), "sha256", "doc")
     .write.mode("append").parquet(content))


def start(spark: SparkSession, content: str, groups: str, checkpoint: str,
          trigger: dict = UNTIL_NOW) -> StreamingQuery:
    """Keep (digest, keep, group_size) of everything loaded; each batch writes the digests it changed."""
    schema = spark.read.parquet(content).schema
    rows = spark.readStream.schema(schema).parquet(content).select("digest", "id", "locator")
    state = rows.groupBy("digest").agg(
        F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{groups}/batch={batch_id}")

    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    try:
        for key, value in STATE_CONF.items():
            spark.conf.set(key, value)
        return (state.writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def read_groups(spark: SparkSession, content: str, groups: str) -> DataFrame:
    """The latest state of each digest.  Sizes and kept identifiers only grow, so the latest is the largest."""
    kind = dict(spark.read.parquet(content).dtypes)["id"]
    rows = spark.read.schema(f"digest binary, {KEEP.format(id=kind)}, group_size bigint").parquet(groups)
    return rows.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def resolved(spark: SparkSession, content: str, groups: str, text: str = "text") -> DataFrame:
    """Every loaded row's (id, locator, sha256, keep, group_size), hits checked byte by byte."""
    rows = spark.read.parquet(content)
    state = read_groups(spark, content, groups)
    hits = (rows.select("id", "locator", "digest", "sha256", F.col(f"doc.{text}").alias("text"))
            .join(state.where("group_size > 1"), "digest"))
    hits = stored(hits.withColumn("text", normal("text")), "hits")
    kept = hits.where(F.col("locator") == F.col("keep.locator")).select("digest", F.col("text").alias("kept_text"))
    differ = stored(hits.join(kept, "digest").where("text != kept_text").select("digest").distinct(), "differ")

    found = (rows.select("id", "locator", "digest", "sha256").join(state, "digest")
             .join(differ, "digest", "left_anti"))
    apart = hits.drop("keep", "group_size").join(differ, "digest", "left_semi")
    by_text = apart.groupBy("digest", "text").agg(
        F.max(F.struct("id", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    columns = ["id", "locator", "sha256", "keep", "group_size"]
    return found.select(*columns).union(apart.join(by_text, ["digest", "text"]).select(*columns))


def run(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
        digest_bytes: int = 32) -> tuple[str, DataFrame]:
    """Load ``docs`` and run the stream over it: the content table's folder and :func:`resolved`."""
    spark, base = docs.sparkSession, shared_dir(docs.sparkSession, "exact-dedup")
    content, groups = f"{base}/content", f"{base}/groups"
    load(docs, content, id_col, text, digest_bytes)
    start(spark, content, groups, f"{base}/checkpoint").awaitTermination()
    return content, resolved(spark, content, groups, text)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                     digest_bytes: int = 32) -> DataFrame:
    """A row per row: its id, the id of the row that stays, the group's size, whether it stays, its text's SHA-256."""
    _, found = run(docs.select(id_col, text), id_col, text, digest_bytes)
    return found.select(F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size",
                        (F.col("locator") == F.col("keep.locator")).alias("kept"),
                        F.lower(F.hex("sha256")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    content, found = run(docs, id_col, text)
    stay = found.where(F.col("locator") == F.col("keep.locator")).select("locator")
    return docs.sparkSession.read.parquet(content).join(stay, "locator", "left_semi").select("doc.*")
