"""The order of the mix in the pipeline's rows, as they are read again from several files."""

import corpus_pipeline
from footfall.llm import mixing
from footfall.llm.oracle import TARGETS, TARGETS_OTHER

STAGES = dict(corpus_pipeline.STAGES)


def many_files(spark, path):
    """Documents in files of unlike length, with three sources that have a target and one that has none."""
    rows = spark.range(6000).selectExpr(
        "id AS doc_id", "concat('word ', id, repeat(' and more', cast(id % 97 as int))) AS text", "'en' AS lang",
        "CASE WHEN id % 7 < 3 THEN 'src0' WHEN id % 7 < 5 THEN 'src1' WHEN id % 7 = 5 THEN 'src2' ELSE 'other' END AS source",
        "0L AS n_chars")
    rows.repartition(7, "lang", "source", "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def test_order_of_the_rows_that_run_returns(spark, tmp_path, monkeypatch):
    docs = many_files(spark, f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, STAGES[n]) for n in ("mixing", "byte-level BPE")])
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # so that a stage writes several files
    try:
        found = corpus_pipeline.run(spark, str(tmp_path)).collect()
        plan = {r.doc_id: r for r in mixing.slots(docs, TARGETS, other=TARGETS_OTHER).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(found) == len(plan) == 6000
    assert [(r.mix_slot, r.mix_row) for r in found] == [(plan[r.doc_id].mix_slot, plan[r.doc_id].mix_row) for r in found]
    assert [r.doc_id for r in found] == sorted(plan, key=lambda i: (plan[i].mix_slot, plan[i].mix_row))
    assert all(plan[r.doc_id].mix_release <= r.mix_slot < plan[r.doc_id].mix_deadline for r in found)


def test_files_of_the_last_stage_are_ranges_of_the_mix(spark, tmp_path):
    docs = many_files(spark, f"{tmp_path}/in")
    STAGES["byte-level BPE"](spark, docs, "").write.parquet(f"{tmp_path}/out")
    for part in sorted((tmp_path / "out").glob("part-*.parquet")):
        places = [(r.mix_slot, r.mix_row) for r in spark.read.parquet(str(part)).coalesce(1).collect()]
        assert places == sorted(places)
