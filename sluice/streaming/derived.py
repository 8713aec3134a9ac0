"""Streams over the routed topics: order lookups, wide orders and daily actives."""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.align import align
from sluice.functions.rows import emit
from sluice.operators.daily_active import enrich_dau, first_visits
from sluice.operators.lookup import no_user, provinces, users
from sluice.operators.orders import (
    decode_fact, enrich_orders, merge_wide, pack_sides, with_order_date,
)
from sluice.schemas import DAU_INFO, ORDER_DETAIL, ORDER_INFO, PAGE_LOG
from sluice.sources.keyed_table import KeyedTable
from sluice.streaming.jobs import INTERVAL, run_id, start_batches, state_partitions
from sluice.streaming.wide import start_merge


def wide_orders(
    orders: DataFrame,
    details: DataFrame,
    within: str = "1 day",
    delay: str = "1 hour",
    salts: int = 4,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Stream-stream merge of order and detail messages (topic records).

    Record times stand in for event times, because a detail's own time may be missing. Both sides
    must arrive ``within`` of each other, which also bounds the state. The details of one order
    are spread over ``salts`` tasks, each of which gets a copy of the order, so an order with a
    large share of all details does not fill one task.

    Inner by default. With ``keep_unmatched`` details without an order in reach come out too, once
    the watermark has passed them, with the order's fields at their defaults. Records later than the
    watermark are in neither; :func:`late_rows` counts them.
    """
    info, detail = pack_sides(
        with_order_date(decode_fact(orders, ORDER_INFO, ("timestamp",))).withColumnRenamed("timestamp", "order_at"),
        decode_fact(details, ORDER_DETAIL, ("timestamp",)).withColumnRenamed("timestamp", "detail_at"),
        ("order_at",),
        ("detail_at",),
    )
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    info = info.withWatermark("order_at", delay).withColumn("_copy", copies)
    detail = detail.withWatermark("detail_at", delay).withColumn(
        "_salt", F.pmod(F.xxhash64("_detail.detail_id"), F.lit(salts)).cast("int")
    )
    near = F.expr(
        f"detail_at >= order_at - interval {within} and detail_at <= order_at + interval {within}"
    )
    on = (F.col("_did") == F.col("_oid")) & (F.col("_salt") == F.col("_copy")) & near
    if keep_unmatched:
        return merge_wide(detail.join(info, on, "leftOuter"), all_present=False)
    return merge_wide(detail.join(info, on, "inner"), all_present=True)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark in the progress reports that Spark still holds of a query;
    the table of :mod:`sluice.streaming.progress` has those of all batches."""
    return sum(
        state["numRowsDroppedByWatermark"]
        for report in query.recentProgress for state in json.loads(report.json)["stateOperators"]
    )


def start_order_wide(
    spark: SparkSession,
    orders,
    details,
    path: str,
    checkpoint: str,
    trigger: dict = INTERVAL,
    partitions: int | None = None,
    within: str = "1 day",
    delay: str = "1 hour",
    salts: int = 4,
    keep_unmatched: bool = False,
) -> StreamingQuery:
    """Wide orders in parquet at ``path``, by ``run`` and ``batch_id``, exactly once.

    Batches are merged as in :mod:`sluice.streaming.wide`. With ``keep_unmatched`` it is Spark's own stream
    merge of :func:`wide_orders`, with all rows in its state store: for topics that come as they arise.
    """
    if not keep_unmatched:
        return start_merge(spark, orders, details, path, checkpoint, trigger, partitions, within, delay, salts, full=False)
    wide = wide_orders(orders.stream(spark), details.stream(spark), within, delay, salts, keep_unmatched)
    writer = wide.writeStream.format("parquet").option("path", path)
    with state_partitions(spark, partitions):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


# Ours: topic of orders with their looked-up columns.
ENRICHED_ORDERS = "DWD_ORDER_INFO_ENRICHED"


def lookup_sides(dims: KeyedTable, facts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Province and user sides as the dimension table stands now; users only as far as ``facts``
    (with a ``user_id``) name them, if given."""
    ids = None
    if facts is not None:
        ids = facts.filter(~no_user(F.col("user_id"))).select(F.col("user_id").cast("string").alias("id"))
    return (
        provinces(dims.current("DIM:BASE_PROVINCE", images=True)),
        users(dims.current("DIM:USER_INFO", ids, images=True)),
    )


@contextmanager
def looked_up(dims: KeyedTable, facts: DataFrame):
    """:func:`lookup_sides` for a batch; the province side, of which the size is checked, is read once."""
    province_side, user_side = lookup_sides(dims, facts)
    province_side = province_side.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield province_side, user_side
    finally:
        province_side.unpersist()


def start_order_enrich(
    spark: SparkSession, orders, dims: KeyedTable, sink, checkpoint: str, trigger: dict = INTERVAL
) -> StreamingQuery:
    """Order messages with dates and looked-up columns, to a topic :func:`wide_orders` can read.

    The dimension table is read anew for every batch; a dimension that comes later than its order
    leaves the defaults.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch)
        # Read twice: for the user ids and for the rows.
        info = align(with_order_date(decode_fact(batch, ORDER_INFO)), ORDER_INFO).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        try:
            with looked_up(dims, info) as sides:
                messages = enrich_orders(info, *sides).select(
                    F.lit(ENRICHED_ORDERS).alias("topic"),
                    F.col("id").cast("string").alias("key"),
                    F.to_json(F.struct(*ORDER_INFO.names)).alias("value"),
                )
                sink.write(messages, run, batch_id)
        finally:
            info.unpersist()

    return start_batches(orders.stream(spark), enrich, checkpoint, trigger)


DAU_SPACE = "DAU:"


def dau_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    """A table for :func:`start_daily_active`: the earliest view of a device and day stays."""
    return KeyedTable(spark, path, wins="first", images=False, **options)


def start_daily_active(
    spark: SparkSession,
    pages,
    table: KeyedTable,
    checkpoint: str,
    trigger: dict = INTERVAL,
    dims: KeyedTable | None = None,
    tz: str = "UTC",
) -> StreamingQuery:
    """Keeps ``table``, of :func:`dau_table`, at one row per device and day; read it with
    :func:`daily_active`.

    No state and no watermark: each batch gives its first views, and the table keeps the earliest of
    them, however late or early a device's clock makes it. A view without ``ts`` belongs to no day.
    With ``dims`` the rows get their looked-up columns, from the dimension table as it stands then.
    """
    if table.wins != "first":
        raise ValueError("daily actives need a table in which the first row wins")

    def save(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch)
        decoded = batch.withColumn("_p", F.from_json("value", PAGE_LOG))
        row = F.struct("_p.*", "partition", "offset")
        views = emit(decoded, F.when(F.col("_p").isNotNull(), row))
        carried = ("partition", "offset")
        first = first_visits(views, tie=carried, tz=tz, carry=carried).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if dims is None:
                table.upsert(_dau_rows(first), run, batch_id)
                return
            with looked_up(dims, first) as sides:
                table.upsert(_dau_rows(enrich_dau(first, *sides, carry=carried)), run, batch_id)
        finally:
            first.unpersist()

    return start_batches(pages.stream(spark), save, checkpoint, trigger)


def _dau_rows(dau: DataFrame) -> DataFrame:
    return dau.select(
        F.concat(F.lit(DAU_SPACE), "dt").alias("space"),
        F.col("mid").alias("id"),
        F.to_json(F.struct(*DAU_INFO.names)).alias("data"),
        F.lit("U").alias("op"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
        F.col("ts").alias("at"),
    )


def daily_active(table: KeyedTable, dt: str | None = None) -> DataFrame:
    """Daily actives of one day, or of all days; other spaces of the table are not opened."""
    rows = table.current(prefix=DAU_SPACE) if dt is None else table.current(DAU_SPACE + dt)
    return rows.select(F.from_json("data", DAU_INFO).alias("d")).select("d.*")
