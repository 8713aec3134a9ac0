"""Orders: typed facts, dimension lookups and the wide merge with details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.align import align, overlay, type_default
from sluice.functions.rows import emit
from sluice.functions.scalars import create_date, create_hour
from sluice.functions.sizes import BROADCAST_ROWS
from sluice.operators.lookup import with_lookups
from sluice.schemas import ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, strings


def decode_fact(values: DataFrame, schema, carry: tuple[str, ...] = ()) -> DataFrame:
    """Fact messages (JSON ``value``) as typed rows. Numbers may be quoted; absent fields take
    the record's default."""
    text = strings(" ".join(schema.names))
    decoded = values.withColumn("_d", F.from_json("value", text))
    return emit(decoded, F.when(F.col("_d").isNotNull(), F.struct(*carry, *typed_fact(schema))))


def typed_fact(schema) -> list[Column]:
    """A record's fields from the texts decoded as ``_d``."""
    return [
        F.coalesce(F.col("_d")[f.name].try_cast(f.dataType), type_default(f.dataType)).alias(f.name)
        for f in schema
    ]


def with_order_date(info: DataFrame) -> DataFrame:
    """Fills ``create_date`` and ``create_hour`` from ``create_time``."""
    created = F.col("create_time")
    return info.withColumn("create_date", create_date(created)).withColumn(
        "create_hour", create_hour(created)
    )


def enrich_orders(
    info: DataFrame, provinces: DataFrame, users: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Fills the looked-up columns; an order without a match keeps the defaults."""
    looked_up = [
        "province_name", "province_area_code", "province_3166_2_code", "province_iso_code",
        "user_age", "user_gender",
    ]
    base = info.drop(*looked_up)
    joined = with_lookups(
        base, provinces, users, F.col("province_id"), F.col("user_id"), broadcast_rows
    )
    typed = joined.withColumnRenamed("province_3166_2", "province_3166_2_code").withColumn(
        "user_age", F.coalesce(F.col("user_age").try_cast("int"), F.lit(0))
    )
    return align(typed, ORDER_INFO)


def pack_sides(
    info: DataFrame, detail: DataFrame,
    carry_info: tuple[str, ...] = (), carry_detail: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Both sides packed as one struct each, under the wide record's names, beside the join key."""

    def pack(side: DataFrame, names: list[str], own_id: str, key: Column, into: str, carry) -> DataFrame:
        fields = [F.col("id").alias(own_id), *[n for n in names if n != "id"]]
        return side.select(key, F.struct(*fields).alias(into), *carry)

    i = pack(info, ORDER_INFO.names, "order_id", F.col("id").alias("_oid"), "_info", carry_info)
    d = pack(
        detail, ORDER_DETAIL.names, "detail_id", F.col("order_id").alias("_did"), "_detail", carry_detail
    )
    return i, d


def merge_wide(joined: DataFrame, all_present: bool, carry: tuple[str, ...] = ()) -> DataFrame:
    """Wide records from ``_info`` and ``_detail``: the detail is laid over the order, so a shared
    field is the detail's whenever there is a detail, even when it is NULL."""
    layers = [(F.col(c), joined.schema[c].dataType) for c in ("_info", "_detail")]
    return joined.select(*carry, *overlay(ORDER_WIDE, layers, all_present))


def order_wide(info: DataFrame, detail: DataFrame, how: str = "inner") -> DataFrame:
    """Orders merged with their details, ``how`` being ``inner`` or ``full``.

    One order may hold a large share of all details. Runtime skew handling can split the detail
    side of an inner or left join but of no full join, so the full merge is details left-joined
    to orders, plus the orders that no detail names.
    """
    i, d = pack_sides(info, detail)
    on = F.col("_did") == F.col("_oid")
    if how == "inner":
        return merge_wide(d.join(i, on, "inner"), all_present=True)
    if how != "full":
        raise ValueError(f"how: inner or full, not {how}")
    matched = d.join(i, on, "left").select("_info", "_detail")
    named = d.select("_did").distinct()
    alone = i.join(named, on, "left_anti").select(
        "_info", F.lit(None).cast(d.schema["_detail"].dataType).alias("_detail")
    )
    return merge_wide(matched.unionByName(alone), all_present=False)
