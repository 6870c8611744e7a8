from footfall.llm import exact_dedup

from .conftest import ROWS, fill

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    return sorted(((i, max(g, key=lambda x: (x is not None, x or 0)), len(g)) for g in groups.values() for i in g), key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size) for r in df.collect()), key=str)


def test_odd_rows(odd, none):
    rows = exact_dedup.exact_duplicates(odd)
    assert found(rows) == expected(ROWS)
    assert rows.where("kept").count() == len({(t or "").translate(LOWER) for _, t in ROWS})
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and kept.count() == rows.where("kept").count()
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_texts_with_one_digest_are_told_apart(odd):
    assert found(exact_dedup.exact_duplicates(odd, digest_bytes=1)) == expected(ROWS)
    assert found(exact_dedup.exact_duplicates(odd, digest_bytes=0)) == expected(ROWS)


def test_state_goes_on_with_more_content(spark, tmp_path):
    content, groups, checkpoint = (str(tmp_path / n) for n in ("content", "groups", "checkpoint"))
    parts = [ROWS[:9], ROWS[9:], [(50, "ONE"), (51, "new"), (52, "NEW")]]
    for part in parts:
        exact_dedup.load(fill(spark, part), content)
        exact_dedup.start(spark, content, groups, checkpoint).awaitTermination()
    rows = exact_dedup.resolved(spark, content, groups)
    assert sorted(((r.id, r["keep"].id, r.group_size) for r in rows.collect()), key=str) == expected(sum(parts, []))
