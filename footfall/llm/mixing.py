"""Mix sources to target weights by Pfair scheduling of blocks.

A target gives sources whole parts; sources without a target of their own share one.  The rows of a source, in the
order of a hash of their id, are cut into blocks.  With weight w the k-th block of a source (from 0) is
released at slot floor(k / w) and due by slot ceil((k + 1) / w), and each slot takes the released block with
the earliest deadline.  That keeps every block within its window, so at any slot a source is less than one block
away from its weight, up to the slot at which the first source has no more blocks; from there on its slots stay empty.

The schedule repeats after as many slots as there are parts, so it is made once for that many slots,
a literal in the plan, and the k-th block of a source finds its slot by division.  Numbering a source's
rows does not bring them together: rows are numbered within ranges of the hash, and a small table of
counts says how many come before each range.

Edge cases.  A null source has no target of its own.  Null ids are ordered as empty text; rows with equal ids follow
each other in any order, and every row is kept.  Column names of ``docs`` may be anything but the names added here, all
of which begin with ``mix_`` (an error says so).
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16
RANGE_DIGITS = 3   # a source's rows are numbered in 16 ** 3 ranges of their hash
OTHER = 1          # parts of the sources without a target, if not given


def schedule(parts: list[int]) -> list[int]:
    """The class that has each slot of one period, a period having as many slots as there are parts."""
    total = sum(parts)
    windows = [[(floor(Fraction(k * total, n)), ceil(Fraction((k + 1) * total, n))) for k in range(n)] for n in parts]
    done, slots = [0] * len(parts), []
    for slot in range(total):
        ready = [(windows[c][done[c]][1], c) for c in range(len(parts))
                 if done[c] < parts[c] and windows[c][done[c]][0] <= slot]
        chosen = min(ready)[1]
        slots.append(chosen)
        done[chosen] += 1
    return slots


def order_key(id_col: str) -> Column:
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def slots(docs: DataFrame, targets: Mapping[str, int], id_col: str = "doc_id", source: str = "source",
          other: int = OTHER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with its place in the mix.

    Added are ``mix_class`` (number of the target, the last for the other sources), ``mix_block`` (number of the block
    in its class), ``mix_release``, ``mix_deadline``, ``mix_slot`` and ``mix_row`` (number of the row in its block).
    """
    parts = [*targets.values(), other]
    if min(parts) < 1:
        raise ValueError("every target needs a part at least")
    if clashing := [c for c in docs.columns if c.lower().startswith("mix_")]:
        raise ValueError(f"columns that begin with mix_ are added here, so these cannot be mixed: {clashing}")
    names = F.array(*[F.lit(name) for name in targets]) if targets else F.array().cast("array<string>")
    number = F.coalesce(F.array_position(names, F.col(source)), F.lit(0)).cast("int")
    rows = docs.withColumn("mix_class", F.when(number > 0, number - 1).otherwise(len(targets)))
    rows = rows.withColumn("mix_key", order_key(id_col)).withColumn(
        "mix_range", F.substring("mix_key", 1, RANGE_DIGITS))
    sizes = rows.groupBy("mix_class", "mix_range").agg(F.count(F.lit(1)).alias("mix_size"))
    before = Window.partitionBy("mix_class").orderBy("mix_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("mix_class", "mix_range", F.coalesce(F.sum("mix_size").over(before), F.lit(0)).alias("mix_start"))
    inside = Window.partitionBy("mix_class", "mix_range").orderBy("mix_key", F.col(id_col))
    rows = rows.withColumn("mix_number", F.row_number().over(inside) - 1).join(starts, ["mix_class", "mix_range"])
    rows = rows.withColumn("mix_number", F.col("mix_start") + F.col("mix_number"))
    rows = rows.withColumn("mix_block", F.floor(F.col("mix_number") / block_rows))

    total, plan = sum(parts), schedule(parts)
    mine = [[slot for slot, c in enumerate(plan) if c == which] for which in range(len(parts))]
    part = F.element_at(F.lit(parts), F.col("mix_class") + 1)
    places = F.element_at(F.array(*[F.lit(places) for places in mine]), F.col("mix_class") + 1)
    return _placed(docs, rows.withColumn("mix_part", part.cast("long")).withColumn("mix_places", places),
                   total, block_rows)


def _placed(docs: DataFrame, rows: DataFrame, total: int, block_rows: int) -> DataFrame:
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns], "mix_class", "mix_block",
        F.expr(f"(mix_block * {total}) div mix_part").alias("mix_release"),
        F.expr(f"((mix_block + 1) * {total} + mix_part - 1) div mix_part").alias("mix_deadline"),
        F.expr(f"(mix_block div mix_part) * {total} + element_at(mix_places, cast(mix_block % mix_part as int) + 1)")
        .alias("mix_slot"),
        F.expr(f"mix_number - mix_block * {block_rows}").alias("mix_row"))


def mixed_rows(docs: DataFrame, targets: Mapping[str, int], id_col: str = "doc_id", source: str = "source",
               other: int = OTHER, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows of ``docs``, with its columns, in the order of the mix: partitions and rows within them are in order."""
    rows = slots(docs, targets, id_col, source, other, block_rows)
    return (rows.repartitionByRange("mix_slot", "mix_row").sortWithinPartitions("mix_slot", "mix_row")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
