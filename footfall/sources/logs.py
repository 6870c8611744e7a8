"""A partitioned log as a streaming source: lines with an offset per partition, in a folder of segments.

``path/<partition>/<first>-<end>.log`` holds the lines ``first`` to ``end - 1`` of a partition, one per line of the file.
Segments are never changed; :func:`append_log` adds new ones, and whoever keeps the log may remove the oldest.  The source is written
with Spark's data source interface for Python, so a query's checkpoint holds the offsets: a new query starts where it is told
to, a restarted one goes on from its checkpoint, and offsets that are no longer kept move up to the earliest there is.

Files are opened through Arrow, so ``path`` has to be one that it reaches from all machines: a mounted path, S3, GCS or HDFS.
"""

from __future__ import annotations

import io
import json
import sys
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers need not have this package

SCHEMA = "partition int, offset bigint, value string"
ROWS_PER_TASK = 1_000_000
BATCH = 10_000


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    files, folder = arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (arrow_fs.LocalFileSystem(), path)
    return files, folder.rstrip("/")


def segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """The segments of each partition in order: first offset, end, file."""
    files, folder = _open(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for f in files.get_file_info(arrow_fs.FileSelector(folder, recursive=True, allow_not_found=True)):
        if f.is_file and f.base_name.endswith(".log"):
            first, end = f.base_name.removesuffix(".log").split("-")
            out.setdefault(int(f.path.rsplit("/", 2)[1]), []).append((int(first), int(end), f.path))
    return {p: sorted(own) for p, own in sorted(out.items())}


def append_log(lines: DataFrame, path: str, partition: Column) -> list[tuple[int, int, int]]:
    """Add the column ``value`` of ``lines`` to the partitions given by ``partition``: (partition, first, end) of what was added.

    One writer at a time.  Lines of a partition come in any order; a line end inside a value is written as a blank.  A task that
    runs again finds its segment there and leaves it.
    """
    ends = {p: own[-1][1] for p, own in segments(path).items()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _open(path)
        number, n, out, temp, done = None, 0, None, "", []

        def close() -> None:
            if out is not None:
                out.close()
                first = ends.get(number, 0)
                name = f"{folder}/{number}/{first:020d}-{first + n:020d}.log"
                if files.get_file_info(name).is_file:
                    files.delete_file(temp)
                else:
                    files.move(temp, name)
                done.append((number, first, first + n))

        for batch in batches:
            for p, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != number:
                    close()
                    number, n = p, 0
                    files.create_dir(f"{folder}/{p}", recursive=True)
                    temp = f"{folder}/{p}/{uuid4().hex}.tmp"
                    out = files.open_output_stream(temp)
                out.write((value or "").replace("\r", " ").replace("\n", " ").encode() + b"\n")
                n += 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*done)], ["partition", "first", "end"])

    rows = lines.select(partition.cast("int").alias("_p"), F.col("value").cast("string"))
    added = rows.repartition("_p").sortWithinPartitions("_p").mapInArrow(write, "partition long, first long, end long")
    return sorted(tuple(r) for r in added.collect())   # a row per partition


def remove_segment(path: str, name: str) -> None:
    """Give up a segment, which must be the oldest of its partition; the newest has the end of the partition and stays."""
    own = next(own for own in segments(path).values() if any(f == name for _, _, f in own))
    if own[0][2] != name or len(own) < 2:
        raise ValueError(f"{name} is not the oldest of several segments")
    _open(path)[0].delete_file(name)


class Span(InputPartition):
    """Lines ``start`` to ``end - 1`` of a partition, and the files that have them."""

    def __init__(self, number: int, start: int, end: int, files: list[tuple[int, str]]):
        super().__init__(number)
        self.number, self.start, self.end, self.files = number, start, end, files


def spans(path: str, start: dict[str, int], end: dict[str, int], rows: int = ROWS_PER_TASK) -> list[Span]:
    """What lies between two offsets, cut for tasks of ``rows`` lines; what is no longer kept is passed over."""
    out = []
    for p, own in segments(path).items():
        low, high = max(start.get(str(p), 0), own[0][0]), min(end.get(str(p), 0), own[-1][1])
        for a in range(low, high, rows):
            b = min(a + rows, high)
            out.append(Span(p, a, b, [(first, f) for first, last, f in own if first < b and last > a]))
    return out


def read_span(path: str, span: Span) -> Iterator[pa.RecordBatch]:
    files, _ = _open(path)
    offsets, values = [], []
    for first, name in span.files:
        with files.open_input_stream(name) as stream, io.BufferedReader(stream) as lines:
            for at, line in enumerate(lines, first):
                if at >= span.end:
                    break
                if at >= span.start:
                    offsets.append(at)
                    values.append(line.rstrip(b"\n").decode())
                    if len(values) == BATCH:
                        yield _batch(span.number, offsets, values)
                        offsets, values = [], []
    if values:
        yield _batch(span.number, offsets, values)


def _batch(number: int, offsets: list[int], values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number] * len(values), pa.int32()), pa.array(offsets, pa.int64()), pa.array(values, pa.string())],
        ["partition", "offset", "value"])


def first_offsets(path: str, start: str) -> dict[str, int]:
    """``earliest``, ``latest``, or saved offsets as JSON, of which those no longer kept move up; others start at the earliest."""
    own = segments(path)
    if start == "latest":
        return {str(p): s[-1][1] for p, s in own.items()}
    saved = {} if start == "earliest" else json.loads(start)
    return {str(p): max(int(saved.get(str(p), 0)), s[0][0]) for p, s in own.items()}


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.start = options["path"], options.get("start", "earliest")
        self.rows = int(options.get("rowspertask", ROWS_PER_TASK))

    def initialOffset(self) -> dict:
        return first_offsets(self.path, self.start)

    def latestOffset(self) -> dict:
        return first_offsets(self.path, "latest")

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return spans(self.path, start, end, self.rows)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return read_span(self.path, partition)


class LogReader(DataSourceReader):
    """The whole log, or the lines between the options ``start`` and ``end`` (offsets as JSON)."""

    def __init__(self, options: dict[str, str]):
        self.path, self.rows = options["path"], int(options.get("rowspertask", ROWS_PER_TASK))
        self.start, self.end = options.get("start", "earliest"), options.get("end", "latest")

    def partitions(self) -> list[Span]:
        end = first_offsets(self.path, "latest") if self.end == "latest" else json.loads(self.end)
        return spans(self.path, first_offsets(self.path, self.start), end, self.rows) or [Span(0, 0, 0, [])]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return read_span(self.path, partition)


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "partitioned_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(dict(self.options))

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(dict(self.options))


def _options(path: str, **options: str | dict | None) -> dict[str, str]:
    """Offsets may be given as numbers by partition."""
    text = {k: json.dumps({str(p): o for p, o in v.items()}) if isinstance(v, dict) else v for k, v in options.items() if v is not None}
    return {"path": path, **text}


def log_stream(spark: SparkSession, path: str, start: str | dict[int, int] = "earliest") -> DataFrame:
    """The lines of a log as a stream, with their partition and offset."""
    spark.dataSource.register(LogSource)
    return spark.readStream.format(LogSource.name()).options(**_options(path, start=start)).load()


def read_log(spark: SparkSession, path: str, start: str | dict[int, int] = "earliest", end: str | dict[int, int] = "latest") -> DataFrame:
    """The lines between two offsets, a missing partition up to 0."""
    spark.dataSource.register(LogSource)
    return spark.read.format(LogSource.name()).options(**_options(path, start=start, end=end)).load()
