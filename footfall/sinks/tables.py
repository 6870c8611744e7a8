"""Result tables: append, replace, and the keyed updates a stream makes batch by batch.

A keyed table is a folder of Parquet files with one sub folder per run and batch, ``run=R/batch_id=N``.  A
run is a streaming query with its checkpoint, which numbers its batches from 0.  A batch writes its own
folder and nothing else, so a batch that is run again after a failure replaces what it wrote the first time,
every update happens exactly once, and a query that starts on a new checkpoint adds to what earlier runs left.
The current value of a key is worked out on reading: the sum of its increments, or its latest value.
Folders below the batch (``date=...``) let a reader or the next batch open the days it needs only.
:mod:`footfall.sinks.versions` folds old batches into a base, so that what a reader opens does not grow with the batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.sinks import versions
from footfall.sinks.versions import BATCH, RUN, by_folder

ONE_RUN = "0"   # of callers that number all their batches themselves


# ---- whole tables -------------------------------------------------------------------------

def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Write a catalog table, replacing the one there is; its files lie in the warehouse or in ``path``."""
    writer = by_folder(df, partition_by).write.mode("overwrite").partitionBy(*partition_by)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to a catalog table, creating it first if need be."""
    df.write.mode("append").saveAsTable(table)


def append_files(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Add rows to a folder of files."""
    by_folder(df, partition_by).write.mode("append").partitionBy(*partition_by).format(fmt).save(path)


def jdbc_options(url: str, table: str, batch_size: int = 1000, **options: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **options}


def append_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, connections: int = 16,
                **options: str) -> None:
    """Add rows to a database table, in batches, over at most ``connections`` connections."""
    (df.write.mode("append").format("jdbc")
     .options(**jdbc_options(url, table, batch_size, numPartitions=str(connections), **options)).save())


# ---- keyed tables -------------------------------------------------------------------------

def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                run: str = ONE_RUN) -> None:
    """What one batch adds to a keyed table; running the batch again replaces it."""
    folder = f"{path}/{RUN}={run}/{BATCH}={batch_id}"
    by_folder(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None,
                 run: str = ONE_RUN, at: versions.Snapshot | None = None) -> DataFrame:
    """All rows of a keyed table with their ``run`` and ``batch_id``; with ``before``, of ``run`` only batches below it.

    A batch that asks for what was there before it must not see its own earlier attempt.  A table
    nobody has written to yet is empty.  ``at`` is the state to read, the newest one if not given.
    """
    seen = at or versions.snapshot(spark, path)
    if before is None:
        return versions.read(spark, path, schema, seen)
    return versions.read(spark, path, schema, seen.before(run, before)).where((F.col(RUN) != run) | (F.col(BATCH) < before))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder of Parquet files, or no rows where the folder is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_sums(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], value: str,
              before: int | None = None, run: str = ONE_RUN, at: versions.Snapshot | None = None) -> DataFrame:
    """A table of increments: each key with the sum of its increments."""
    return (read_batches(spark, path, schema, before, run, at).groupBy(*keys).agg(F.sum(value).alias(value)))


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], value: str,
                before: int | None = None, run: str = ONE_RUN, at: versions.Snapshot | None = None) -> DataFrame:
    """A table of set values: each key with the value of the latest batch that has it.

    Every run counts from nothing, so what several runs set for a key is added up.
    """
    return (read_batches(spark, path, schema, before, run, at).groupBy(*keys, RUN)
            .agg(F.max_by(value, BATCH).alias(value)).groupBy(*keys).agg(F.sum(value).alias(value)))


def upsert_add(df: DataFrame, path: str, batch_id: int, keys: Sequence[str], value: str,
               partition_by: Sequence[str] = (), run: str = ONE_RUN) -> None:
    """Add ``value`` to what each key has (keys not seen before start at 0); see :func:`read_sums`."""
    write_batch(df.groupBy(*keys).agg(F.sum(value).alias(value)), path, batch_id, partition_by, run)


def upsert_set(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
               run: str = ONE_RUN) -> None:
    """Give each key of ``df`` its new value; see :func:`read_latest`."""
    write_batch(df, path, batch_id, partition_by, run)


def insert_new(df: DataFrame, path: str, batch_id: int, schema: T.StructType, keys: Sequence[str],
               run: str = ONE_RUN) -> None:
    """Insert the keys that are not in the table yet, each once."""
    known = read_batches(df.sparkSession, path, schema, batch_id, run).select(*keys)
    write_batch(df.dropDuplicates(list(keys)).join(known, list(keys), "left_anti"), path, batch_id, run=run)


def replace_by_key(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace all rows of every key in ``df``; rows of other keys stay.

    The keys are the folders of the table, so only the folders of these keys are rewritten.
    """
    (by_folder(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))
