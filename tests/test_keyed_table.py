"""Keyed table: order of batches, replay, merging of commits, deletes, snapshots."""

import os
import random

import pytest

from sluice.session import scratch_dir
from sluice.sources.keyed_table import ROW, KeyedTable, _mergeable


@pytest.fixture
def rows(spark):
    def make(*items):
        return spark.createDataFrame(
            [(space, key, data, op, 0, offset, None) for space, key, data, op, offset in items], ROW
        )

    return make


def held(table, space=None):
    return {(r["space"], r["id"]): r["data"] for r in table.current(space).collect()}


def test_empty(spark):
    assert held(KeyedTable(spark, scratch_dir(spark, "keyed"))) == {}


def test_later_batch_wins_whatever_its_offset(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"))
    table.upsert(rows(("s", "1", "old", "I", 900), ("s", "1", "older", "I", 800)), "a", 0)
    assert held(table) == {("s", "1"): "old"}
    table.upsert(rows(("s", "1", "new", "U", 5)), "a", 1)
    assert held(table) == {("s", "1"): "new"}


def test_replayed_batch_changes_nothing(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"))
    assert table.upsert(rows(("s", "1", "a", "I", 1)), "run", 0)
    assert table.upsert(rows(("s", "1", "b", "U", 2)), "run", 1)
    assert not table.upsert(rows(("s", "1", "a", "I", 1)), "run", 0)
    assert not table.upsert(rows(("s", "1", "c", "U", 2)), "run", 1)
    assert held(table) == {("s", "1"): "b"}
    # A new checkpoint starts at batch 0 again under a new run id: its batches count.
    assert table.upsert(rows(("s", "1", "d", "U", 1)), "run2", 0)
    assert held(table) == {("s", "1"): "d"}


def test_delete_keeps_or_hides(spark, rows):
    path = scratch_dir(spark, "keyed")
    KeyedTable(spark, path).upsert(rows(("s", "1", "x", "I", 1), ("s", "2", "y", "I", 2)), "a", 0)
    KeyedTable(spark, path).upsert(rows(("s", "1", "gone", "D", 3)), "a", 1)
    assert held(KeyedTable(spark, path)) == {("s", "1"): "gone", ("s", "2"): "y"}
    assert held(KeyedTable(spark, path, on_delete="remove")) == {("s", "2"): "y"}
    with pytest.raises(ValueError):
        KeyedTable(spark, path, on_delete="maybe")


def test_many_batches_against_a_dict(spark, rows):
    rng = random.Random(3)
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), buckets=3)
    expected = {}
    for batch in range(10):
        items = [
            (rng.choice("ab"), str(rng.randrange(6)), f"{batch}-{i}", "U", i) for i in range(rng.randrange(5))
        ]
        table.upsert(rows(*items), "run", batch)
        for space, key, data, _, _ in items:
            expected[space, key] = data
        assert held(table) == expected
    assert held(table, "a") == {k: v for k, v in expected.items() if k[0] == "a"}


def test_first_wins(spark):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), wins="first")
    for batch, (data, at, offset) in enumerate([("b", 5, 9), ("a", 3, 8), ("c", 3, 9), ("d", 7, 1), ("e", 3, 2)]):
        table.upsert(spark.createDataFrame([("s", "1", data, "U", 0, offset, at)], ROW), "run", batch)
    assert held(table) == {("s", "1"): "e"}
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, wins="biggest")


def test_a_batch_writes_its_own_rows_only(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), buckets=8)
    table.upsert(rows(*[("s", str(i), "a", "I", i) for i in range(20_000)]), "run", 0)
    table.upsert(rows(*[("s", str(i * 7), "b", "U", 1) for i in range(60)], ("s", "7", "older", "U", 0)), "run", 1)
    assert len(os.listdir(f"{table.path}/data/version=1")) >= 8
    assert table.files.names("data") == ["version=1", "version=2"]
    assert spark.read.parquet(f"{table.path}/data/version=2").count() == 60
    table.upsert(rows(("s", "7", "c", "U", 1)), "run", 2)
    assert len([n for n in os.listdir(f"{table.path}/data/version=3") if n.startswith("part=")]) == 1
    assert held(table) == {("s", str(i)): "c" if i == 7 else "b" if i % 7 == 0 and i < 420 else "a" for i in range(20_000)}


@pytest.mark.parametrize("wins", ["last", "first"])
def test_many_deltas_cost_few_rewrites(spark, wins):
    """Rows written over many small batches, merges included, and deltas left per bucket."""
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), wins=wins, buckets=1)
    expected, n = {}, 30
    for batch in range(n):
        at = (batch * 37) % 101
        new = [("s", str(i), f"{batch}", "U", 0, batch, at) for i in range(batch % 5, 400 if not batch else 8)]
        for _, key, data, *_ in new:
            if wins == "last" or key not in expected or at < expected[key][1]:
                expected[key] = (data, at)
        table.upsert(spark.createDataFrame(new, ROW), "run", batch)
    assert {r["id"]: r["data"] for r in table.current("s").collect()} == {k: v[0] for k, v in expected.items()}
    deltas = table._manifest()["live"]["s"]["0"]
    assert len(deltas) < 16
    written = sum(spark.read.parquet(f"{table.path}/data/{v}").count() for v in os.listdir(f"{table.path}/data"))
    assert written < 400 + n * 8 * 4


def test_which_deltas_are_merged():
    sizes = lambda *each: [[v + 1, n] for v, n in enumerate(each)]
    assert _mergeable(sizes(100)) is None
    assert _mergeable(sizes(1000, *[4] * 7)) is None
    assert _mergeable(sizes(1000, *[4] * 8)) == 1
    assert _mergeable(sizes(1000, 60, *[4] * 7)) is None
    assert _mergeable(sizes(1000, 60, *[4] * 8)) == 1
    assert _mergeable(sizes(50, *[4] * 8)) == 0


def test_another_number_of_buckets_deals_rows_anew(spark, rows):
    path = scratch_dir(spark, "keyed")
    items = [(s, str(i), "a", "I", i) for s in "xy" for i in range(50)]
    KeyedTable(spark, path, buckets=2).upsert(rows(*items), "run", 0)
    KeyedTable(spark, path).upsert(rows(("x", "3", "b", "U", 1)), "run", 1)
    assert KeyedTable(spark, path)._manifest()["buckets"] == 2
    table = KeyedTable(spark, path, buckets=7)
    table.upsert(rows(("x", "4", "c", "U", 1)), "run", 2)
    assert table._manifest()["buckets"] == 7 and len(table._manifest()["live"]["y"]) == 7
    changed = {"3": "b", "4": "c"}
    assert held(KeyedTable(spark, path)) == {(s, i): changed.get(i, "a") if s == "x" else "a" for s, i, *_ in items}
    ids = spark.createDataFrame([("4",), ("3",)], "id string")
    assert sorted(r["data"] for r in table.current("x", ids).collect()) == ["b", "c"]


def test_readers_outlive_upserts_until_age_ends_them(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), buckets=2)
    table.upsert(rows(("s", "1", "first", "I", 1)), "run", 0)
    reader = table.current()
    for n in range(1, 41):
        table.upsert(rows(("s", "1", f"{n}", "U", 1)), "run", n)
    assert [r["data"] for r in reader.collect()] == ["first"]
    assert held(table) == {("s", "1"): "40"}
    table.compact()
    last = f"version={table._manifest()['version']}"
    KeyedTable(spark, table.path, keep_days=-1).expire()
    assert held(table) == {("s", "1"): "40"} and table._manifest()["dropped"] == []
    assert table.files.names("data") == [last]


def test_a_crash_while_deleting_loses_nothing(spark, rows):
    """Replaced deltas stay named until a manifest without them is in place."""
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), buckets=1, keep_days=-1)
    for n in range(2):
        table.upsert(rows(("s", "1", f"{n}", "U", 1)), "run", n)
    table.compact()
    create = table.files.create
    table.files.create = lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        table.upsert(rows(("s", "1", "2", "U", 1)), "run", 2)
    table.files.create = create
    assert held(table) == {("s", "1"): "1"}
    table.upsert(rows(("s", "1", "2", "U", 1)), "run", 2)
    table.compact()
    table.expire()
    assert held(table) == {("s", "1"): "2"} and len(table.files.names("data")) == 1


def test_unfinished_commit_is_not_seen(spark, rows):
    """A crash after the data files, before the manifest: readers see the old state, the replay
    overwrites the leftovers."""
    table = KeyedTable(spark, scratch_dir(spark, "keyed"))
    table.upsert(rows(("s", "1", "a", "I", 1)), "run", 0)
    commit = table._commit
    table._commit = lambda manifest: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        table.upsert(rows(("s", "1", "half", "U", 2)), "run", 1)
    assert held(table) == {("s", "1"): "a"}
    table._commit = commit
    table.upsert(rows(("s", "1", "b", "U", 2)), "run", 1)
    assert held(table) == {("s", "1"): "b"}


def test_second_writer_is_refused(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"))
    table.upsert(rows(("s", "1", "a", "I", 1)), "run", 0)
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit({"version": 1, "live": [], "taken": {}})


def test_a_space_opens_its_own_files(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"))
    table.upsert(rows(("s", "1", "a", "I", 1), ("t", "1", "b", "I", 2)), "run", 0)
    assert len(table.current("s").inputFiles()) == len(table.current("t").inputFiles()) == 1
    assert "Exchange" not in table.current("s")._jdf.queryExecution().executedPlan().toString()


def test_point_lookup_reaches_the_scan(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"))
    for n in range(3):
        table.upsert(rows(("s", "1", f"a{n}", "I", 1), ("s", "2", "b", "I", 2)), "run", n)
    found = table.current("s").filter("id = '1'")
    assert "EqualTo(id,1)" in found._jdf.queryExecution().executedPlan().toString()
    assert [r["data"] for r in found.collect()] == ["a2"]


def test_wanted_ids_open_their_buckets_only(spark, rows):
    table = KeyedTable(spark, scratch_dir(spark, "keyed"), buckets=32)
    for n in range(3):
        table.upsert(rows(*[("s", str(i), f"{n}", "I", i) for i in range(n, 200)]), "run", n)
    ids = spark.createDataFrame([("1",), ("5",), ("5",), (None,), ("999",)], "id string")
    found = table.current("s", ids)
    assert sorted((r["id"], r["data"]) for r in found.collect()) == [("1", "1"), ("5", "2")]
    opened = lambda df: {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}
    assert len(opened(found)) <= 3 < len(opened(table.current("s")))
