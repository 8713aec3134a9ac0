"""Joins against small and large lookup sides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.sizes import BROADCAST_ROWS, is_small
from sluice.schemas import PROVINCE_DIM, USER_DIM

# Keys over which facts of no user are spread.
NOBODIES = 1 << 20


def no_user(user_id: Column) -> Column:
    """Whether an id stands for no user: NULL or empty. 0 can be a user's id, so it is looked up."""
    return user_id.isNull() | (user_id.cast("string") == "")


def heavy_keys(rows: DataFrame, key: str, share: float) -> list:
    """The keys that hold more than ``share`` of the rows, found in one pass over the key column.

    Each task counts its frequent keys in a sketch of bounded size, and the sketches are merged; they
    overrate a key by less than ``share`` / 4. At most 2 / ``share`` keys come out.
    """
    most = max(1, math.ceil(2 / share))
    top = F.expr(f"approx_top_k({key}, {most}, {min(1_000_000, 1 << math.ceil(math.log2(8 * most)))})")
    found = rows.filter(F.col(key).isNotNull()).select(key).agg(top.alias("top"), F.count("*").alias("n")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["n"]]


def spread_key_join(left: DataFrame, side: DataFrame, left_key: str, side_key: str, spread: list[str]) -> DataFrame:
    """Left join in which only keys that hold more than a part's share of ``left`` are spread.

    A heavy key's rows go to as many tasks as there are shuffle partitions, by a hash of ``spread``, and its
    rows in ``side`` are copied to each. All other rows of both sides are shuffled once, by their key. Needs
    no runtime re-planning, so it also holds inside a streaming micro-batch.
    """
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left, left_key, 1 / (2 * salts)) if salts > 1 else []
    if not heavy:
        return left.join(side.hint("merge"), F.col(left_key) == F.col(side_key), "left").drop(side_key)
    salt = F.when(F.col(left_key).isin(heavy), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0)
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = side.withColumn("_copy", F.explode(F.when(F.col(side_key).isin(heavy), every).otherwise(F.array(F.lit(0)))))
    on = (F.col(left_key) == F.col(side_key)) & (F.col("_salt") == F.col("_copy"))
    return left.withColumn("_salt", salt).join(copies.hint("merge"), on, "left").drop("_salt", "_copy", side_key)


def small_key_join(
    left: DataFrame,
    side: DataFrame,
    left_key: str,
    side_key: str,
    spread: list[str],
    small: bool,
) -> DataFrame:
    """Left join on a key with few values (a table name, a province).

    Shuffling on such a key alone would put a large share of all rows in one task. The side is
    broadcast when it is proven ``small``; otherwise the keys that hold many rows are spread.
    """
    if small:
        return left.join(F.broadcast(side), F.col(left_key) == F.col(side_key), "left").drop(side_key)
    return spread_key_join(left, side, left_key, side_key, spread)


def provinces(dim_rows: DataFrame) -> DataFrame:
    """Province columns from dimension rows ``(id, data)``."""
    return _images(dim_rows, PROVINCE_DIM).select(
        F.col("dim_id").alias("p_id"),
        F.col("image.name").alias("province_name"),
        F.col("image.area_code").alias("province_area_code"),
        F.col("image.iso_code").alias("province_iso_code"),
        F.col("image.iso_3166_2").alias("province_3166_2"),
    )


def users(dim_rows: DataFrame) -> DataFrame:
    """User columns from dimension rows ``(id, data)``."""
    return _images(dim_rows, USER_DIM).select(
        F.col("dim_id").alias("u_id"),
        F.col("image.gender").alias("user_gender"),
        F.col("image.age").alias("user_age"),
    )


def _images(dim_rows: DataFrame, schema) -> DataFrame:
    """Typed images: from the decoded ones where the rows have them, else from the text."""
    if "image" in dim_rows.columns:
        fields = [F.try_variant_get("image", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema]
        image = F.when(F.col("image").isNotNull(), F.struct(*fields))
    else:
        image = F.from_json("data", schema)
    return dim_rows.select(F.col("id").alias("dim_id"), image.alias("image"))


def with_lookups(
    facts: DataFrame,
    province_side: DataFrame,
    user_side: DataFrame,
    province_id: Column,
    user_id: Column,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Adds province and user columns; facts without a match keep NULLs.

    The user side can be large and is left to Catalyst, which broadcasts by estimated size and
    splits skewed partitions of the fact side at run time. Facts of no user can match none: they
    get keys of their own, spread by a hash of the row, rather than meet in one task.
    """
    nobody = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*facts.columns), F.lit(NOBODIES)).cast("string"))
    uid = F.when(no_user(user_id), nobody).otherwise(user_id.cast("string"))
    keyed = facts.withColumn("_pid", province_id.cast("string")).withColumn("_uid", uid)
    joined = keyed.join(user_side, F.col("_uid") == F.col("u_id"), "left").drop("u_id")
    small = is_small(province_side, broadcast_rows)
    return small_key_join(
        joined, province_side, "_pid", "p_id", spread=facts.columns, small=small
    ).drop("_pid", "_uid")
