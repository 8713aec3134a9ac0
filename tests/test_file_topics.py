"""File topics: folders merged by range, batch ranges read back, replays and crashes."""

import pytest
from pyspark.sql import functions as F

from sluice.session import scratch_dir
from sluice.sources.files import Files
from sluice.sources.sinks import FAN, FileSink, Range, current, mergeable


def messages(spark, batch):
    rows = [("a", str(batch), f"{batch}-{i}") for i in range(2)] + [("b", None, f"{batch}-b")]
    return spark.createDataFrame(rows, "topic string, key string, value string")


def held(df):
    return sorted((r["topic"], r["batch_id"], r["value"]) for r in df.collect())


def expected(batches):
    return sorted(x for b in batches for x in [("a", b, f"{b}-0"), ("a", b, f"{b}-1"), ("b", b, f"{b}-b")])


def test_which_folders_count_and_which_are_merged():
    single = [Range(n, n, 0) for n in range(FAN + 1)]
    assert mergeable(single[:FAN], FAN - 1) is None and mergeable(single, FAN) == single[:FAN]
    assert current([*single, Range(0, FAN - 1, 1)]) == [Range(0, FAN - 1, 1), single[-1]]
    tens = [Range(n * 10, n * 10 + 9, 1) for n in range(FAN)]
    assert mergeable(tens, 10 * FAN) == tens
    assert Range.of(Range(3, 7, 2).name) == Range(3, 7, 2)


def test_many_batches_in_few_files(spark, monkeypatch):
    """Merged twice over while batches go on; every message once, at any time."""
    monkeypatch.setattr("sluice.sources.sinks.FAN", 4)
    sink = FileSink(scratch_dir(spark, "topics"))
    n = 70
    for batch in range(n):
        sink.write(messages(spark, batch), "r", batch)
        if batch in (3, 4, 5, 21):
            assert held(sink.read(spark)) == expected(range(batch + 1))
    assert held(sink.read(spark)) == expected(range(n))
    folders = {f.rsplit("/", 3)[1] for f in sink.read(spark).inputFiles()}
    assert len(folders) <= 3 * 4 and len(sink.read(spark).inputFiles()) <= 5 * len(folders)
    files = Files(spark, sink.path)
    assert len(files.names("run=r")) < 30  # what was merged is deleted, too
    assert held(sink.read(spark, 17, 42)) == expected(range(17, 43))
    assert held(sink.read(spark, from_batch=66)) == expected(range(66, n))
    opened = {f.rsplit("/", 3)[1] for f in sink.read(spark, 69, 69).inputFiles()}
    assert opened == {"batches=69-69-0"}
    assert sink.read(spark, run="other").count() == 0


def test_a_replayed_batch_replaces_its_own_messages(spark, monkeypatch):
    monkeypatch.setattr("sluice.sources.sinks.FAN", 3)
    sink = FileSink(scratch_dir(spark, "topics"))
    for batch in [0, 1, 1, 2, 2, 3, 3, 3]:
        sink.write(messages(spark, batch), "r", batch)
        assert held(sink.read(spark)) == expected(range(batch + 1))


def test_a_crash_while_merging_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr("sluice.sources.sinks.FAN", 3)
    sink = FileSink(scratch_dir(spark, "topics"))
    for batch in range(4):
        sink.write(messages(spark, batch), "r", batch)
    merged = Files(spark, f"{sink.path}/run=r/batches=0-2-1")
    merged.delete("_SUCCESS")  # as if it had not ended
    assert held(sink.read(spark)) == expected(range(4))
    sink.write(messages(spark, 4), "r", 4)
    assert merged.exists("_SUCCESS") and held(sink.read(spark)) == expected(range(5))


def test_runs_stay_apart_and_topics_are_pruned(spark):
    sink = FileSink(scratch_dir(spark, "topics"))
    for run in ("x", "y"):
        sink.write(messages(spark, 0), run, 0)
    assert sink.read(spark).groupBy("run").count().count() == 2 and sink.read(spark, run="x").count() == 3
    plan = sink.read(spark).filter(F.col("topic") == "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


@pytest.mark.parametrize("size, parts", [(1, 1), (1000, 4)])
def test_large_ranges_are_cut(spark, monkeypatch, size, parts):
    monkeypatch.setattr("sluice.sources.sinks.FAN", 2)
    monkeypatch.setattr("sluice.sources.sinks.FILE_BYTES", (1 << 40) // size**4)
    sink = FileSink(scratch_dir(spark, "topics"))
    for batch in range(3):
        rows = spark.range(2000).select(F.lit("hot").alias("topic"), F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
        sink.write(rows.coalesce(1), "r", batch)
    assert sink.read(spark).count() == 6000
    assert (len(sink.read(spark, 0, 1).inputFiles()) > 1) == (parts > 1)
