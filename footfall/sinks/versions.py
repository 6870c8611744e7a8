"""Versions of a keyed table: old batches folded into a base, behind a committed pointer.

A stream that writes a batch every few seconds leaves very many small folders.  Folding takes the batches of a run
up to one that cannot run again, merges their rows by key, writes them as one part of the base, and commits a new version.
A version names the parts of the base and, for each run, the last batch that is in them.  The state of a table
is its newest version plus the committed batches after it:

* ``run=R/batch_id=N``    what one batch wrote; it counts once Spark has put ``_SUCCESS`` there
* ``_base/part=V-...``    merged rows, with the folders of ``partition_by`` below
* ``_versions/V``         the pointer, written last and never changed

Parts have levels.  When ``FANOUT`` parts of a level have come together they are merged into one of the next, so a row
is rewritten as often as there are levels, and a reader opens less than ``FANOUT`` parts per level: their number grows with the
logarithm of the batches, and those that hold a given day do not grow once the day is over.

Nothing is lost or doubled if a writer dies: parts without a pointer are not read, a pointer that was not written to its end is passed over,
and folded batches are removed only after the pointer is there.  A reader that holds a :class:`Snapshot` reads the same rows
until ``KEEP`` further versions have been committed; what older versions alone need is removed.  If two writers commit the same version, one
fails to create its pointer and leaves its batches for the next time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN, BATCH = "run", "batch_id"
BASE, PART, POINTERS = "_base", "part", "_versions"
FOLD_EVERY, FANOUT, KEEP = 64, 8, 4
# How the rows of a key are merged: added up, the latest of each run, or all kept.
ADD, SET, ROWS = "add", "set", "rows"


def by_folder(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a folder together before writing, so that it gets few files.

    A rebalance, unlike a repartition, splits a folder that is too large for one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


@dataclass(frozen=True)
class Snapshot:
    """A state of a table: the parts of the base with their levels, the last folded batch of each run, and the batches after."""
    version: int
    parts: tuple[tuple[str, int], ...]
    folded: dict[str, int]
    batches: tuple[tuple[str, int], ...]

    def before(self, run: str, batch_id: int) -> Snapshot:
        """The state without the batches of ``run`` from ``batch_id`` on; folded batches are always below it."""
        if self.folded.get(run, -1) >= batch_id:
            raise ValueError(f"batch {batch_id} is in the base of the table already")
        return replace(self, batches=tuple((r, n) for r, n in self.batches if r != run or n < batch_id))

    def others(self, run: str | None) -> Snapshot:
        """The state without the batches of ``run`` that are not folded."""
        return replace(self, batches=tuple(b for b in self.batches if b[0] != run))


# ---- folders ------------------------------------------------------------------------------

class Folder:
    """A folder of the table's file system, by Hadoop's own interface."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.path = path
        self.fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def names(self, name: str = "") -> list[str]:
        folder = self.at(name) if name else self._path(self.path)
        return [f.getPath().getName() for f in self.fs.listStatus(folder)] if self.fs.exists(folder) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a new file; fails if there is one."""
        stream = self.fs.create(self.at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _pointers(folder: Folder) -> list[dict]:
    """The versions whose pointers are whole, newest first."""
    out = []
    for name in sorted((n for n in folder.names(POINTERS) if n.isdigit()), key=int, reverse=True):
        try:
            out.append({**json.loads(folder.text(f"{POINTERS}/{name}")), "version": int(name)})
        except ValueError:   # not written to its end
            continue
    return out


def _committed(folder: Folder) -> list[tuple[str, int]]:
    found = []
    for run in folder.names():
        if run.startswith(f"{RUN}="):
            for batch in folder.names(run):
                if batch.startswith(f"{BATCH}=") and folder.fs.exists(folder.at(f"{run}/{batch}/_SUCCESS")):
                    found.append((run.removeprefix(f"{RUN}="), int(batch.removeprefix(f"{BATCH}="))))
    return sorted(found)


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The newest state of the table; a table that nobody has written to yet is empty."""
    folder = Folder(spark, path)
    batches = _committed(folder)   # before the pointer, so that a batch folded meanwhile is in one of them at least
    newest = next(iter(_pointers(folder)), {"version": 0, "parts": [], "folded": {}})
    folded = newest["folded"]
    return Snapshot(newest["version"], tuple((p, n) for p, n in newest["parts"]), folded,
                    tuple((r, n) for r, n in batches if n > folded.get(r, -1)))


# ---- reading ------------------------------------------------------------------------------

def _columns(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])


def read(spark: SparkSession, path: str, schema: T.StructType, at: Snapshot) -> DataFrame:
    """The rows of a state with their ``run`` and ``batch_id``, of which merged rows have what :func:`fold` gave them."""
    columns = _columns(schema)
    files = spark.read.schema(columns)
    rows = []
    if at.parts:
        folders = [f"{path}/{BASE}/{PART}={p}" for p, _ in at.parts]
        rows.append(files.option("basePath", f"{path}/{BASE}").parquet(*folders).select(*columns.names))
    if at.batches:
        folders = [f"{path}/{RUN}={r}/{BATCH}={n}" for r, n in at.batches]
        rows.append(files.option("basePath", path).parquet(*folders).select(*columns.names))
    if not rows:
        return spark.createDataFrame([], columns)
    return rows[0].unionByName(rows[1]) if len(rows) > 1 else rows[0]


# ---- folding ------------------------------------------------------------------------------

def merged(rows: DataFrame, schema: T.StructType, keys: Sequence[str], value: str | None, how: str) -> DataFrame:
    """The rows of each key merged.  What was added up belongs to no run any more: its run is empty, its batch -1."""
    if how == ADD:
        rows = rows.groupBy(*keys).agg(F.sum(value).alias(value)).withColumns({RUN: F.lit(""), BATCH: F.lit(-1).cast("long")})
    elif how == SET:
        rows = rows.groupBy(*keys, RUN).agg(F.max_by(value, BATCH).alias(value), F.max(BATCH).alias("_last")).withColumnRenamed("_last", BATCH)
    return rows.select(*_columns(schema).names)


def fold(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], value: str | None, how: str,
         upto: int, run: str, partition_by: Sequence[str] = (), fanout: int = FANOUT, keep: int = KEEP) -> int | None:
    """Fold the batches of ``run`` up to ``upto`` into the base; the new version, None if there was nothing to fold.

    ``upto`` must be a batch that will not run again.
    """
    now = snapshot(spark, path)
    batches = tuple((r, n) for r, n in now.batches if r == run and n <= upto)
    if not batches:
        return None
    level, merging = 0, []
    while len(same := [p for p in now.parts if p[1] == level]) + 1 >= fanout:
        merging += same
        level += 1
    version = now.version + 1
    part = f"{version}-{uuid.uuid4().hex}"
    rows = merged(read(spark, path, schema, replace(now, parts=tuple(merging), batches=batches)), schema, keys, value, how)
    by_folder(rows, partition_by).write.partitionBy(*partition_by).parquet(f"{path}/{BASE}/{PART}={part}")
    parts = [p for p in now.parts if p not in merging] + [(part, level)]
    folder = Folder(spark, path)
    if not commit(folder, version, {"parts": parts, "folded": {**now.folded, run: batches[-1][1]}}):
        folder.remove(f"{BASE}/{PART}={part}")
        return None
    vacuum(folder, keep)
    return version


def commit(folder: Folder, version: int, state: dict) -> bool:
    """Write the pointer; False if another writer was first.  A number that a writer began and did not end is not used again."""
    if any(p["version"] >= version for p in _pointers(folder)):
        return False
    taken = [int(n) for n in folder.names(POINTERS) if n.isdigit()]
    try:
        folder.create(f"{POINTERS}/{max([version, *(n + 1 for n in taken)])}", json.dumps(state))
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def vacuum(folder: Folder, keep: int = KEEP) -> None:
    """Remove what the newest ``keep`` versions do not need: older pointers, their parts, and batches folded by then."""
    found = _pointers(folder)
    kept, old = found[:keep], found[keep:]
    if not old:
        return
    needed = {p for v in kept for p, _ in v["parts"]}
    for name in folder.names(BASE):
        part = name.removeprefix(f"{PART}=")
        if part not in needed and int(part.partition("-")[0]) <= kept[-1]["version"]:
            folder.remove(f"{BASE}/{name}")
    for run, n in _committed(folder):
        if n <= min(v["folded"].get(run, -1) for v in [*kept, old[0]]):
            folder.remove(f"{RUN}={run}/{BATCH}={n}")
    for v in old:
        folder.remove(f"{POINTERS}/{v['version']}")


def fold_sometimes(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], value: str | None, how: str,
                   batch_id: int, run: str, partition_by: Sequence[str] = (), every: int = FOLD_EVERY) -> None:
    """To be called by each batch after it wrote: every ``every`` batches, fold those before it.

    A batch may run again until the next one has begun, so it does not fold itself.
    """
    if batch_id and batch_id % every == 0:
        fold(spark, path, schema, keys, value, how, batch_id - 1, run, partition_by)
