"""Folding batches into a base: bounded reads, pinned readers, and writers that die at the worst moments."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from footfall import schemas
from footfall.sinks import tables, versions

KEYS, SCHEMA = ["date", "userid", "adid"], schemas.AD_USER_CLICK_COUNT


@pytest.fixture
def table(spark, tmp_path):
    class Table:
        path = str(tmp_path / "t")

        def write(self, batch, *rows, run="0"):
            tables.write_batch(spark.createDataFrame(list(rows), SCHEMA).coalesce(1), self.path, batch, ["date"], run)

        def write_quickly(self, batch, *rows):
            """What a batch of Spark leaves, without a job."""
            folder = f"{self.path}/run=0/batch_id={batch}"
            for date in {r[0] for r in rows}:
                os.makedirs(f"{folder}/date={date}")
                columns = list(zip(*(r[1:] for r in rows if r[0] == date)))
                pq.write_table(pa.table(dict(zip(("userid", "adid", "click_count"), (pa.array(c, pa.int64()) for c in columns)))),
                               f"{folder}/date={date}/part-0.parquet")
            open(f"{folder}/_SUCCESS", "w").close()

        def fold(self, upto, how=versions.ADD, run="0", **options):
            return versions.fold(spark, self.path, SCHEMA, KEYS, "click_count", how, upto, run, ["date"], **options)

        def sums(self, **options):
            return sorted(tuple(r) for r in tables.read_sums(spark, self.path, SCHEMA, KEYS, "click_count", **options).collect())

        def latest(self):
            return sorted(tuple(r) for r in tables.read_latest(spark, self.path, SCHEMA, KEYS, "click_count").collect())

        def now(self):
            return versions.snapshot(spark, self.path)
    return Table()


def folders(path):
    return sum(len(dirs) for _, dirs, _ in os.walk(path))


def test_reads_do_not_grow_with_the_batches(spark, table):
    opened, listed = {}, {}
    for batch in range(200):
        table.write_quickly(batch, (f"d{batch // 50}", 1, 1, 1), (f"d{batch // 50}", batch % 7, 2, 1))
        versions.fold_sometimes(spark, table.path, SCHEMA, KEYS, "click_count", versions.ADD, batch, "0", ["date"], every=10)
        if batch % 50 == 49:
            rows = tables.read_batches(spark, table.path, SCHEMA, before=batch)
            opened[batch] = len(rows.where(f"date = 'd{batch // 50}'").inputFiles())
            listed[batch] = folders(table.path)
    now = table.now()
    assert len(now.batches) <= 10 and len(now.parts) <= 2 * versions.FANOUT
    assert opened[199] <= opened[49] + versions.FANOUT and max(opened.values()) < 60
    assert max(listed.values()) < 150       # 200 batches without folding would be 400
    ones = [(d, u, a, n) for d, u, a, n in table.sums() if a == 1]
    assert ones == [(f"d{k}", 1, 1, 50) for k in range(4)]
    assert sum(n for _, _, a, n in table.sums() if a == 2) == 200


def test_a_part_without_a_pointer_is_not_read(table, monkeypatch):
    for batch in range(4):
        table.write(batch, ("d", 1, 1, 10 ** batch))
    before = table.sums()
    with monkeypatch.context() as m:
        def die(*_):
            raise RuntimeError("lost")
        m.setattr(versions, "commit", die)
        with pytest.raises(RuntimeError):
            table.fold(2)
    assert table.sums() == before == [("d", 1, 1, 1111)] and table.now().parts == ()
    assert table.fold(2) == 1 and table.sums() == before and len(table.now().batches) == 1


def test_a_pointer_not_written_to_its_end_is_passed_over(spark, table):
    for batch in range(6):
        table.write(batch, ("d", 1, 1, 1))
    assert table.fold(1) == 1
    versions.Folder(spark, table.path).create("_versions/2", '{"parts": [["2-x", 0')
    assert table.sums() == [("d", 1, 1, 6)] and table.now().version == 1
    table.fold(3)
    assert table.now().version == 3 and table.sums() == [("d", 1, 1, 6)]
    table.fold(4)
    assert table.now().version == 4 and table.sums() == [("d", 1, 1, 6)]


def test_dying_before_old_batches_are_removed_doubles_nothing(table, monkeypatch):
    for batch in range(3):
        table.write(batch, ("d", 1, 1, 1))
    with monkeypatch.context() as m:
        def die(*_):
            raise RuntimeError("lost")
        m.setattr(versions, "vacuum", die)
        with pytest.raises(RuntimeError):
            table.fold(1)
    assert table.sums() == [("d", 1, 1, 3)]
    for batch in range(3, 12):
        table.write(batch, ("d", 1, 1, 1))
        table.fold(batch - 1, keep=1)
    assert table.sums() == [("d", 1, 1, 12)]


def test_another_writer_was_first(spark, table, monkeypatch):
    for batch in range(2):
        table.write(batch, ("d", 1, 1, 1))
        table.write(batch, ("d", 1, 1, 10), run="b")
    old = table.now()
    assert table.fold(0, run="b") == 1
    with monkeypatch.context() as m:
        m.setattr(versions, "snapshot", lambda *_: old)
        assert table.fold(0) is None
    assert table.sums() == [("d", 1, 1, 22)] and os.listdir(f"{table.path}/_base").__len__() == 1
    assert table.fold(0) == 2 and table.sums() == [("d", 1, 1, 22)]


def test_a_batch_runs_again_after_it_was_folded_before(table):
    for batch in range(3):
        table.write(batch, ("d", 1, 1, 1))
    table.fold(1)
    table.write(2, ("d", 1, 1, 5))   # the batch after the folded ones, once more
    assert table.sums() == [("d", 1, 1, 7)] and table.sums(before=2) == [("d", 1, 1, 2)]
    with pytest.raises(ValueError):
        table.sums(before=1)


def test_a_pinned_reader_keeps_its_rows(table):
    pinned = {}
    for batch in range(8):
        table.write(batch, ("d", 1, 1, 1), (f"e{batch}", 2, 2, 2))
        table.fold(batch - 1, fanout=2)
        pinned[batch] = (table.now(), table.sums())
        for back in range(max(0, batch - versions.KEEP + 1), batch + 1):
            at, rows = pinned[back]
            assert table.sums(at=at) == rows, (batch, back)


def test_latest_values_and_all_rows(spark, table, tmp_path):
    for batch, n in enumerate((5, 3, 8, 2)):
        table.write(batch, ("d", 1, 1, n), (f"d{batch}", 1, 1, n))
    table.write(0, ("d", 1, 1, 100), run="b")
    expected = table.latest()
    assert ("d", 1, 1, 102) in expected
    for upto in (0, 1, 2):
        table.fold(upto, versions.SET, fanout=2)
        assert table.latest() == expected
    path, users = str(tmp_path / "u"), lambda *u: spark.createDataFrame([(x,) for x in u], schemas.AD_BLACKLIST)
    for batch, new in enumerate(((1, 2), (2, 3), (3, 4), (1, 5))):
        tables.insert_new(users(*new), path, batch, schemas.AD_BLACKLIST, ["userid"])
        versions.fold(spark, path, schemas.AD_BLACKLIST, ["userid"], None, versions.ROWS, batch - 1, "0")
    assert sorted(r.userid for r in tables.read_batches(spark, path, schemas.AD_BLACKLIST).collect()) == [1, 2, 3, 4, 5]
