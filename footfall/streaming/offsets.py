"""What a streaming query has read, for people and monitoring.

Restarting needs none of this: the checkpoint of a query holds its offsets, and a batch that was
not finished is run again with the same input.
"""

from __future__ import annotations

import ast

from pyspark.sql.streaming import StreamingQuery


def offset_report(query: StreamingQuery) -> list[dict]:
    """Batch, source, first and end offset and row count of the recent batches of a query."""
    return [{
        "batch_id": progress.batchId,
        "source": source.description,
        "from_offset": source.startOffset,
        "until_offset": source.endOffset,
        "rows": source.numInputRows,
    } for progress in query.recentProgress for source in progress.sources]


def offset_ranges(query: StreamingQuery, start: dict[int, int] | None = None) -> list[tuple[int, int, int, int]]:
    """(batch, partition, first offset, end) of what each recent batch read; partitions without new lines are left out.

    For sources whose offset is a number per partition, such as :mod:`footfall.sources.logs`, or by topic as with Kafka.
    The report of a query's very first batch does not say where it began: that is ``start``, or 0.
    """
    out = []
    for report in offset_report(query):
        first, end = (_by_partition(report[k]) for k in ("from_offset", "until_offset"))
        first = first or start or {}
        out += [(report["batch_id"], p, first.get(p, 0), n) for p, n in end.items() if n > first.get(p, 0)]
    return sorted(set(out))


def _by_partition(offset: str | None) -> dict[int, int]:
    found = ast.literal_eval(offset or "None") or {}   # the report has the offset as Python writes it
    parts = [v if isinstance(v, dict) else {k: v} for k, v in found.items()]
    return {int(k): int(v) for part in parts for k, v in part.items()}
