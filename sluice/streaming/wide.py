"""Wide orders as a stream merge of orders and details: inner, or two-sided with an account of every record.

Each micro-batch is merged by a batch join with the rows that are still open, those that a later record can
meet; what is open after it is a folder of the checkpoint, written anew per batch. The batch itself is decoded
once and kept in such a folder for as long as it takes. So a batch costs its own rows and the open ones, no row
has an entry in a state store, and nothing is held on a heap.

The two-sided merge gives matched records, orders without details and details without an order, the unmatched
ones once the watermark has passed them. Records that come later than the watermark, and those that cannot be
decoded or have no time, go to a table of their own.

Details of an order that holds more than a task's share are spread over ``salts`` tasks, each with a copy of the order.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.rows import emit
from sluice.operators.lookup import heavy_keys
from sluice.operators.orders import merge_wide, pack_sides, typed_fact, with_order_date
from sluice.operators.parse import unreadable
from sluice.schemas import CORRUPT, ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, strings
from sluice.sources.files import Files
from sluice.sources.sinks import COMPACT, side_by_side
from sluice.streaming.jobs import INTERVAL, run_id, start_batches

MATCHED, ORDER_ALONE, DETAIL_ALONE = "matched", "order_alone", "detail_alone"
LATE, NO_TIME, UNREADABLE = "late", "no_time", "unreadable"
ORDER, DETAIL = "order", "detail"
_RECORD = ["topic", "partition", "offset", "timestamp", "value"]
_OPEN = ["side", "_key", "_at", "_info", "_detail", "new", "met"]
# Rows of both sides that a task of the merge is to take, at most.
TASK_ROWS = 250_000


def two_sides(orders: DataFrame, details: DataFrame, strict: bool) -> DataFrame:
    """Records of both sides, decoded once: ``side``, ``_key``, ``_info`` or ``_detail``, ``bad`` and the record.

    With ``strict`` a value that is no JSON object is ``bad``; without, it is a record of defaults, and NULL is none.
    """

    def side(records: DataFrame, schema, name: str) -> DataFrame:
        fields, options = strings(" ".join(schema.names)), {}
        if strict:
            fields, options = fields.add(CORRUPT, "string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        decoded = records.withColumn("_d", F.from_json("value", fields, options))
        bad = unreadable(F.col("_d")) if strict else F.lit(False)
        row = F.struct(F.lit(name).alias("side"), bad.alias("bad"), F.struct(*_RECORD).alias("_record"), *typed_fact(schema))
        return emit(decoded, row if strict else F.when(F.col("_d").isNotNull(), row))

    carry = ("side", "bad", "_record")
    info, detail = pack_sides(with_order_date(side(orders, ORDER_INFO, ORDER)), side(details, ORDER_DETAIL, DETAIL), carry, carry)
    info, detail = info.withColumnRenamed("_oid", "_key"), detail.withColumnRenamed("_did", "_key")
    return info.unionByName(detail, allowMissingColumns=True)


def fate(watermark_ms: int) -> Column:
    """Why a record is in no merge; NULL if it is in one."""
    at = F.col("_record.timestamp")
    late = F.unix_micros(at) <= watermark_ms * 1000
    return F.when(F.col("bad"), UNREADABLE).when(at.isNull(), NO_TIME).when(late & (watermark_ms > 0), LATE)


class OpenRows:
    """What is open after each batch, and how far the times of both sides have come; the last two are kept."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.files = spark, Files(spark, path)

    def _batches(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names() if n.endswith(".json") and n[0] != ".")

    def before(self, batch_id: int) -> tuple[dict, DataFrame | None]:
        """What the batch before left; a replayed batch begins with the same."""
        earlier = [b for b in self._batches() if b < batch_id]
        if not earlier:
            return {"watermark": 0}, None
        return json.loads(self.files.read(f"{earlier[-1]}.json")), self.spark.read.parquet(f"{self.files.path}/rows-{earlier[-1]}")

    def put(self, batch_id: int, rows: DataFrame, marks: dict) -> None:
        self.files.delete(f"{batch_id}.json")
        rows.write.mode("overwrite").options(**COMPACT).parquet(f"{self.files.path}/rows-{batch_id}")
        self.files.create(f"{batch_id}.json", json.dumps(marks))
        for old in [b for b in self._batches() if b <= batch_id][:-2]:
            self.files.delete(f"{old}.json")
            self.files.delete(f"rows-{old}")


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.expr(f"unix_micros(timestamp_seconds(0) + interval {interval})")).first()[0]


def _marks(new: DataFrame, before: dict, delay: int) -> tuple[dict, int]:
    """How far the times have come after a batch, and its sound rows. The slower side counts."""
    marks, n = dict(before), 0
    sound = new.filter("_why is null or _why = 'late'").groupBy("side").agg(F.max("_at").alias("at"), F.count("*").alias("n"))
    for r in sound.collect():
        n += r["n"]
        marks[r["side"]] = max(r["at"], marks.get(r["side"], r["at"]))
    if ORDER in marks and DETAIL in marks:
        marks["watermark"] = max(marks["watermark"], (min(marks[ORDER], marks[DETAIL]) - delay) // 1000)
    return marks, n


def merge_batch(live: DataFrame, n: int, watermark_ms: int, within: int, salts: int, full: bool) -> tuple[DataFrame, DataFrame]:
    """A batch's merge, and the rows that are open after it.

    ``live`` has some ``n`` rows: the batch's (``new``) and the open ones, each with whether it was ``met`` before.
    Pairs of two open rows are known; unmatched rows come out when they close.
    """
    spark = live.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_ROWS))

    def side(name: str, own: str, prefix: str) -> DataFrame:
        names = {"_key": f"_{prefix}id", "_at": f"{prefix}_at", "new": f"{prefix}_new", "met": f"{prefix}_met"}
        return live.filter(F.col("side") == name).select(*(F.col(a).alias(b) for a, b in names.items()), own)

    info, detail = side(ORDER, "_info", "o"), side(DETAIL, "_detail", "d")
    heavy = heavy_keys(detail, "_did", 1 / (2 * parts)) if parts > 1 and salts > 1 else []
    none, every = F.array(F.lit(0)), F.sequence(F.lit(0), F.lit(salts - 1))
    hot_order, hot_detail = (F.col(c).isin(heavy) if heavy else F.lit(False) for c in ("_oid", "_did"))
    copies = info.withColumn("_copy", F.explode(F.when(hot_order, every).otherwise(none)))
    salt = F.when(hot_detail, F.pmod(F.xxhash64("_detail.detail_id"), F.lit(salts)).cast("int")).otherwise(0)
    near = F.abs(F.col("d_at") - F.col("o_at")) <= within
    on = (F.col("_did") == F.col("_oid")) & near
    if heavy:
        on &= F.col("_salt") == F.col("_copy")
        left = detail.withColumn("_salt", salt).repartition(parts, "_did", "_salt")
        right = copies.repartition(parts, "_oid", "_copy")
    else:
        # A salt that is always 0 would be folded out of the join, which then deals both sides out anew to the
        # session's few partitions, however many rows there are.
        left, right = detail.repartition(parts, "_did"), info.repartition(parts, "_oid")
    closed = lambda at: F.col(at) + within <= watermark_ms * 1000
    if not full:
        return left.join(right, on, "inner").filter("o_new or d_new").select("_info", "_detail"), live.filter(~closed("_at"))
    kind = (
        F.when(F.col("_oid").isNotNull() & F.col("_did").isNotNull(), F.when(F.col("o_new") | F.col("d_new"), MATCHED))
        .when(F.col("_did").isNotNull(), F.when(~F.col("d_met") & closed("d_at"), DETAIL_ALONE))
        .when(~F.col("o_met") & closed("o_at") & ~hot_order, ORDER_ALONE)
    )
    out = left.join(right, on, "fullOuter").select(kind.alias("kind"), "_info", "_detail").filter("kind is not null")
    if heavy:
        # Of a spread order some copies may have met no detail; whether any has is asked for once.
        times = detail.filter(hot_detail).select("_did", "d_at").distinct()
        lone = info.filter(hot_order & ~F.col("o_met") & closed("o_at")).join(times, (F.col("_did") == F.col("_oid")) & near, "left_anti")
        out = out.unionByName(lone.select(F.lit(ORDER_ALONE).alias("kind"), "_info", F.lit(None).cast(live.schema["_detail"].dataType).alias("_detail")))
    # Rows are met or not by their key and time alone; only those can meet an open one that are near the end.
    reach = watermark_ms * 1000 - 2 * within
    times = info.filter(F.col("o_at") >= reach).select("_oid", "o_at").distinct().join(
        detail.filter(F.col("d_at") >= reach).select("_did", "d_at").distinct(), (F.col("_did") == F.col("_oid")) & near
    )
    pairs = [times.select(F.lit(n).alias("side"), F.col(k).alias("_key"), F.col(t).alias("_at")) for n, k, t in ((ORDER, "_oid", "o_at"), (DETAIL, "_did", "d_at"))]
    now = pairs[0].unionByName(pairs[1]).distinct().withColumn("_now", F.lit(True))
    still = live.filter(~closed("_at")).join(now, ["side", "_key", "_at"], "left")
    return out, still.withColumn("met", F.col("met") | F.coalesce("_now", F.lit(False))).select(*_OPEN)


def start_merge(
    spark: SparkSession, orders, details, path: str, checkpoint: str, trigger: dict, partitions: int | None,
    within: str, delay: str, salts: int, full: bool,
) -> StreamingQuery:
    """The stream of both merges: ``full`` writes ``merged`` and ``left_out`` below ``path``, else pairs to ``path``."""
    reach, wait = _micros(spark, within), _micros(spark, delay)

    def save(batch: DataFrame, batch_id: int) -> None:
        at = f"run={run_id(batch)}/batch_id={batch_id}"
        state = OpenRows(batch.sparkSession, f"{checkpoint}/open")
        before, kept = state.before(batch_id)
        why = fate(before["watermark"])
        time, record = F.unix_micros("_record.timestamp"), F.when(F.col("_why").isNotNull(), F.col("_record"))
        # Decoded once; the record itself only stays where it is left out and told.
        new = batch.withColumn("_why", why).select(
            "side", "_key", time.alias("_at"), "_info", "_detail", "_why", *([record.alias("_record")] if full else [])
        )
        files, held = Files(batch.sparkSession, checkpoint), f"kept/batch-{batch_id}"
        try:
            new.write.mode("overwrite").options(**COMPACT).parquet(f"{files.path}/{held}")
            new = batch.sparkSession.read.schema(new.schema).parquet(f"{files.path}/{held}")
            marks, n = _marks(new, before, wait)
            live = new.filter("_why is null").withColumns({"new": F.lit(True), "met": F.lit(False)}).select(*_OPEN)
            if kept is not None:
                n += before["open"]
                live = live.unionByName(kept.withColumn("new", F.lit(False)).select(*_OPEN))
            out, still = merge_batch(live, n, marks["watermark"], reach, salts, full)
            with side_by_side(batch.sparkSession):
                if full:
                    wide = merge_wide(out, all_present=False, carry=("kind",))
                    wide.write.mode("overwrite").options(**COMPACT).partitionBy("kind").parquet(f"{path}/merged/{at}")
                    left = new.filter("_why is not null").select(F.col("_why").alias("reason"), "side", "_record.*")
                    left.write.mode("overwrite").options(**COMPACT).partitionBy("reason").parquet(f"{path}/left_out/{at}")
                else:
                    merge_wide(out, all_present=True).write.mode("overwrite").options(**COMPACT).parquet(f"{path}/{at}")
            open_rows = n if not marks["watermark"] else live.filter(F.col("_at") + reach > marks["watermark"] * 1000).count()
            state.put(batch_id, still, {**marks, "open": open_rows})
        finally:
            files.delete(held)

    rows = two_sides(orders.stream(spark), details.stream(spark), strict=full)
    return start_batches(rows, save, checkpoint, trigger, partitions)


def start_order_merge(
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
) -> StreamingQuery:
    """Merged orders and left-out records below ``path``, exactly once; see :func:`merged` and :func:`left_out`."""
    return start_merge(spark, orders, details, path, checkpoint, trigger, partitions, within, delay, salts, full=True)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """Wide orders with their ``kind``: matched, order_alone or detail_alone."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ORDER_WIDE)
    return spark.read.schema(f"{fields}, run string, batch_id long, kind string").parquet(f"{path}/merged").drop("run", "batch_id")


def left_out(spark: SparkSession, path: str) -> DataFrame:
    """Records that are in no merge, with their ``reason``: late, no_time or unreadable."""
    fields = "side string, topic string, partition int, offset long, timestamp timestamp, value string"
    return spark.read.schema(f"{fields}, run string, batch_id long, reason string").parquet(f"{path}/left_out").drop("run", "batch_id")
