"""Columns of a corpus that are named like those the operators use inside."""

import pytest
from pyspark.sql import functions as F

from footfall.llm import exact_dedup, mixing, near_dedup

NAMES = ["a.b", "c`d", "keep", "keep_id", "keep_node", "copy", "__copy", "node", "label", "digest", "locator", "id", "sha256", "band"]


@pytest.fixture
def wide(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = spark.createDataFrame([(1, text), (2, text), (3, text + " more"), (4, "other"), (4, "other"), (5, None)],
                                 "doc_id long, text string")
    return rows.select("*", *[F.lit(i).alias(name) for i, name in enumerate(NAMES)])


def test_exact_dedup(wide):
    kept = exact_dedup.drop_exact_duplicates(wide)
    assert kept.columns == wide.columns
    assert sorted(r[0] for r in kept.collect()) == [2, 3, 4, 5]


def test_near_dedup(wide):
    kept = near_dedup.drop_near_duplicates(wide)
    assert kept.columns == wide.columns
    assert sorted(r[0] for r in kept.collect()) == [1, 4, 5]


def test_mixing_says_which_names_clash(wide):
    with pytest.raises(ValueError, match="mix_row"):
        mixing.slots(wide.withColumn("mix_row", F.lit(1)), {}, source="text")
