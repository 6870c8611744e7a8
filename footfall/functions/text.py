"""Text and set helpers as Column functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Whether a text field holds something, as a filter: both NULL and ``""`` mean absent.

    Written as a bare comparison (NULL for NULL) so that it reaches the files of a scan.
    """
    return c != ""


def split_ids(c: Column) -> Column:
    """The ids packed in ``"1,2,3"`` as an array, blanks dropped."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def joined_set(c: Column, separator: str = "|") -> Column:
    """The distinct present values of a group in sorted order, as one text."""
    return F.array_join(F.array_sort(F.collect_set(F.when(present(c), c))), separator)


def as_list(value: str | Iterable[object] | None) -> list[str]:
    """A parameter given as ``"a,b"``, as a list or not at all, as a list of text."""
    if value is None:
        return []
    parts = value.split(",") if isinstance(value, str) else [str(v) for v in value]
    return [p.strip() for p in parts if p.strip()]


def flow_pairs(flow: str | Iterable[object]) -> list[tuple[int, str, str]]:
    """``"1,2,3"`` as ``(step, from, to)``: ``[(1, "1", "2"), (2, "2", "3")]``."""
    pages = as_list(flow)
    if len(pages) < 2:
        raise ValueError("a page flow needs at least two pages")
    return [(i + 1, a, b) for i, (a, b) in enumerate(zip(pages, pages[1:]))]
