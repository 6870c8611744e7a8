"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What every job here relies on.  Anything the caller or the cluster sets wins.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    STATE_PROVIDER: ROCKSDB,
}


def build_session(app: str = "footfall", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def need_map_state(spark: SparkSession) -> None:
    """Map state needs a store of several column families: RocksDB takes the place of Spark's default in this session.

    Queries with a checkpoint keep the store they began with; any other store that was set is left.
    """
    if spark.conf.get(STATE_PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_PROVIDER, ROCKSDB)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode with that setting unset, since on a
    cluster no other machine could read it back.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="footfall-")
    return f"{base.rstrip('/')}/footfall/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    Later stages no longer depend on how it came about, and its size is known when they are planned.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
