"""Row-level building blocks over whole DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def emit(df: DataFrame, row: Column) -> DataFrame:
    """The non-NULL values of struct ``row``, as columns.

    Stands in for filter + select over decoded JSON: a filter would be pushed below the decoding
    projection and decode every text twice, this expands to a generator it cannot pass.
    """
    return df.select(F.explode_outer(F.array(row)).alias("_r")).filter("_r is not null").select("_r.*")


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key by ``order``.

    Spark takes the limit of one row into each input task, before the shuffle, so a key that holds
    a large share of the rows arrives as one row per task.
    """
    return _edge(df, keys, [F.col(c).desc() for c in order])


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ``order``; limited before the shuffle like :func:`latest_by`."""
    return _edge(df, keys, [F.col(c).asc() for c in order])


def _edge(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
