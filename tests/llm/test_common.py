"""Shared helpers: filters of bounded size, names that clash with nothing, scratch folders."""

import os

import numpy as np
from pyspark.sql import functions as F

from sluice.llm import common


def test_a_filter_holds_what_was_put_in_and_little_else(spark):
    numbers = spark.range(0, 200_000, 2).select(F.xxhash64("id").alias("x")).repartition(6)
    bloom = common.Bloom.of(numbers.union(numbers.limit(5)).union(spark.sql("select cast(null as long)")))
    held = np.array([r["x"] for r in numbers.collect()])
    assert bloom.passing(held).all()
    others = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 100_000)
    assert bloom.passing(others).mean() < 0.02
    rows = spark.range(0, 2000).select("id", F.when(F.col("id") < 1990, F.xxhash64("id")).alias("x"))
    kept = {r["id"] for r in common.passing(rows, "x", bloom).collect()}
    assert {i for i in range(0, 1990, 2)} <= kept and len(kept) < 1050 and not kept & set(range(1990, 2000))


def test_an_empty_filter_passes_nothing(spark):
    bloom = common.Bloom.of(spark.range(0))
    assert not bloom.passing(np.arange(1000)).any()


def test_unused_names(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "a int, _A int, b int")
    assert [common.unused(rows, n) for n in ("c", "b", "a")] == ["c", "_b", "__a"]


def test_folders_are_written_and_discarded(spark):
    path = common.written(spark.range(3), "x")
    assert spark.read.parquet(path).count() == 3
    common.discard(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_disposable_folders_go_at_the_end(spark):
    with common.disposable(spark):
        inner = common.written(spark.range(3), "inner")
        assert spark.read.parquet(inner).count() == 3
    outer = common.written(spark.range(4), "outer")
    assert not os.path.exists(inner.removeprefix("file:")) and spark.read.parquet(outer).count() == 4
