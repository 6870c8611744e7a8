"""The corpus queries against their SQL, and the pipeline's stages one after the other."""

import duckdb
import pytest
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
import public_tokenizers
from footfall.llm import near_dedup, quality
from footfall.llm.bpe import read_ranks
from footfall.llm.queries import ORACLE, QUERIES
from tests.llm.test_near_dedup import brute

SF = "/root/testdata/sf0.01"


def test_all_are_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} >= set(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    expected = con.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    rows = sorted(map(str, (tuple(r) for r in found.select(*columns).collect())))
    assert rows == sorted(map(str, expected.project(", ".join(columns)).fetchall()))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if i < 4:
            assert set(docs.columns) == set(before.columns)
            kept.append({r.doc_id: r.text for r in docs.collect()})
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).value
    ids = list(first)
    good = quality.probabilities([first[i].encode() for i in ids], *model) >= 0.5
    assert set(kept[0]) == {i for i, g in zip(ids, good) if g}
    largest = {}
    for i, text in kept[0].items():
        key = text.encode().lower()
        largest[key] = max(i, largest.get(key, i))
    assert set(kept[1]) == set(largest.values())
    texts = sorted(kept[1].items())
    classes = brute([t for _, t in texts])
    smallest = {}
    for (i, _), c in zip(texts, classes):
        smallest.setdefault(c, i)
    assert set(kept[2]) == set(smallest.values()) and kept[3] == kept[2]
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    rows = docs.collect()
    assert all(r.decodes and r.n_tokens == len(other.encode_ordinary(kept[3][r.doc_id])) for r in rows)
    assert {r.doc_id for r in rows} == set(kept[3])


def test_hot_group_of_near_copies_has_one_row_left(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(200)) + f" tail{i}") for i in range(120)]
    left = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in left] == [0]
