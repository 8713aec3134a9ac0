"""Registered queries: each takes ``(spark, sf_dir)``, reads whole tables and returns typed rows.

Streaming queries replay the derived topics in several batches through the real jobs, in a fresh
folder below the shared scratch folder, and return what the sinks hold.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.align import align
from sluice.functions.changes import dim_key
from sluice.operators import change_routes as cr
from sluice.operators import daily_active as da
from sluice.operators import log_routes as lr
from sluice.operators import orders
from sluice.operators.parse import parse_change, parse_log
from sluice.plans import envelopes as env
from sluice.schemas import ORDER_DETAIL, ORDER_INFO, ORDER_WIDE, PAGE_LOG
from sluice.session import scratch_dir
from sluice.sources.control import control_files, publish_control
from sluice.sources.keyed_table import KeyedTable
from sluice.sources.sinks import FileSink
from sluice.sources.topics import ReplayTopic, from_offsets, next_offsets
from sluice.streaming import derived, dim_state, jobs, progress, wide

LOG_TOPIC, DB_TOPIC = lr.LogTopics.source, cr.ChangeTopics.source


# Building blocks


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return parse_log(env.app_log(spark, sf))


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return cr.routed_changes(cr.coded_changes(parse_change(env.change_log(spark, sf))), env.control(spark))


def _order_info(spark: SparkSession, sf: str) -> DataFrame:
    return align(orders.with_order_date(env.order_info(spark, sf)), ORDER_INFO)


def _order_detail(spark: SparkSession, sf: str) -> DataFrame:
    return align(env.order_detail(spark, sf), ORDER_DETAIL)


def _dim_table(spark: SparkSession, sf: str) -> KeyedTable:
    """A dimension table filled by the change stream."""
    log = parse_change(env.change_log(spark, sf, only=env.DIM_TABLES))
    routed = cr.routed_changes(cr.coded_changes(log), env.control(spark))
    dims = KeyedTable(spark, scratch_dir(spark, "dims"))
    dims.upsert(cr.dim_rows(routed), "batch", 0)
    return dims


def _dims(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return derived.lookup_sides(_dim_table(spark, sf))


# App log


def parse_log_query(spark: SparkSession, sf: str) -> DataFrame:
    log = F.col("log")
    return _log(spark, sf).select(
        "partition", "offset", "verdict",
        log["common"]["mid"].alias("mid"),
        log["page"]["page_id"].alias("page_id"),
        F.size(log["displays"]).alias("n_displays"),
        F.size(log["actions"]).alias("n_actions"),
        log["start"]["open_ad_ms"].try_cast("bigint").alias("open_ad_ms"),
        log["err"].alias("err"),
        log["ts"].try_cast("bigint").alias("ts"),
    )


def log_page_json(spark: SparkSession, sf: str) -> DataFrame:
    return lr.page_log(_log(spark, sf)).select(F.to_json(F.struct(*PAGE_LOG.names)).alias("value"))


def log_error(spark: SparkSession, sf: str) -> DataFrame:
    return lr.error_log(_log(spark, sf)).select("partition", "offset", "value")


def log_unrouted(spark: SparkSession, sf: str) -> DataFrame:
    return lr.unrouted_log(_log(spark, sf)).select("partition", "offset", "value")


def log_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    damaged = parse_log(env.damaged_app_log(spark, sf))
    return lr.quarantined_log(damaged).select("partition", "offset", "reason")


def log_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return lr.log_messages(_log(spark, sf))


# Change stream


def parse_cdc(spark: SparkSession, sf: str) -> DataFrame:
    chg = F.col("chg")
    return parse_change(env.change_log(spark, sf)).select(
        "partition", "offset",
        chg["type"].alias("type"), chg["table"].alias("table_name"), chg["data"].alias("data"),
    )


def cdc_op_code(spark: SparkSession, sf: str) -> DataFrame:
    coded = cr.coded_changes(parse_change(env.change_log(spark, sf)))
    return coded.select("partition", "offset", "table_name", "type", "op")


def cdc_fact(spark: SparkSession, sf: str) -> DataFrame:
    return cr.fact_rows(_routed(spark, sf))


def cdc_fact_topics(spark: SparkSession, sf: str) -> DataFrame:
    return cr.fact_rows(_routed(spark, sf)).groupBy("topic").agg(F.count("*").alias("n"))


def cdc_dim(spark: SparkSession, sf: str) -> DataFrame:
    return cr.dim_rows(_routed(spark, sf)).select(
        dim_key(F.col("space"), F.col("id")).alias("dim_key"),
        "op", "data", "src_partition", "src_offset",
    )


def cdc_dim_latest(spark: SparkSession, sf: str) -> DataFrame:
    latest = cr.latest_dims(cr.dim_rows(_routed(spark, sf)))
    return latest.select(dim_key(F.col("space"), F.col("id")).alias("dim_key"), "op", "data")


def cdc_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return cr.change_messages(_routed(spark, sf))


# Orders and daily actives


def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Orders copied into the wide record's shape: shared fields only, the rest at defaults."""
    return align(_order_info(spark, sf), ORDER_WIDE, fill={"order_id": F.col("id")})


def page_to_dau(spark: SparkSession, sf: str) -> DataFrame:
    return da.page_to_dau(lr.page_log(_log(spark, sf)))


def order_date_hour(spark: SparkSession, sf: str) -> DataFrame:
    return orders.with_order_date(env.order_info(spark, sf)).select(
        "id", "create_time", "create_date", "create_hour"
    )


def order_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return orders.enrich_orders(_order_info(spark, sf), *_dims(spark, sf))


def order_wide_inner(spark: SparkSession, sf: str) -> DataFrame:
    return orders.order_wide(_order_info(spark, sf), _order_detail(spark, sf))


def order_wide_full(spark: SparkSession, sf: str) -> DataFrame:
    return orders.order_wide(_order_info(spark, sf), _order_detail(spark, sf), "full")


def order_wide_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain: lookups on orders, then the merge with details."""
    return orders.order_wide(order_enrich(spark, sf), _order_detail(spark, sf))


def _first_visits(spark: SparkSession, sf: str) -> DataFrame:
    pages = lr.page_log(_log(spark, sf), carry=("partition", "offset"))
    return da.first_visits(pages, tie=("partition", "offset"))


def dau_first_visit(spark: SparkSession, sf: str) -> DataFrame:
    return _first_visits(spark, sf)


def dau_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return da.enrich_dau(_first_visits(spark, sf), *_dims(spark, sf))


# Streams


def _replayed(run, append, chunks: list) -> None:
    """Appends each chunk and runs the stream over it, restarting from its checkpoint."""
    for chunk in chunks:
        append(chunk)
        run().awaitTermination()


def _halves(records: DataFrame, source: DataFrame | None = None) -> tuple[list[DataFrame], int]:
    """Records before and from the middle offset, that of the ``source`` they are decoded from if given."""
    top = (records if source is None else source).agg(F.max("offset")).first()[0]
    cut = (top + 1) // 2
    return [records.filter(F.col("offset") < cut), records.filter(F.col("offset") >= cut)], cut


def source_topic(spark: SparkSession, sf: str) -> DataFrame:
    """The app-log topic read as a stream, record by record."""
    root = scratch_dir(spark, "source_topic")
    topic = ReplayTopic(f"{root}/topic", LOG_TOPIC, max_files_per_trigger=4)
    topic.append(env.app_log(spark, sf))
    (
        topic.stream(spark).writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(**jobs.ONCE).start().awaitTermination()
    )
    return spark.read.parquet(f"{root}/out").select("topic", "partition", "offset", "value")


def source_from_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Half the topic split by one job, the rest, from the offsets after it, by another."""
    records = env.app_log(spark, sf)
    first = _halves(records)[0][0]
    parts = [first, from_offsets(records, next_offsets(first))]
    jobs_of = [lr.log_messages(parse_log(p)).select(F.lit(n + 1).alias("job"), "topic", "value") for n, p in enumerate(parts)]
    return jobs_of[0].unionByName(jobs_of[1])


def resume_from_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """The log split stopped after half the topic and restarted on the same checkpoint."""
    root = scratch_dir(spark, "resume")
    halves, _ = _halves(env.app_log(spark, sf))
    topic, sink = ReplayTopic(f"{root}/topic", LOG_TOPIC), FileSink(f"{root}/out")
    _replayed(
        lambda: jobs.start_log_split(spark, topic, sink, f"{root}/checkpoint", trigger=jobs.ONCE),
        topic.append, halves,
    )
    return sink.read(spark).select("topic", "value", "batch_id")


def log_split_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The log split over several files per batch and several batches."""
    root = scratch_dir(spark, "log_split")
    topic = ReplayTopic(f"{root}/topic", LOG_TOPIC, max_files_per_trigger=3)
    # By hash: dealing rows out in turn would sort each task's texts first.
    topic.append(env.app_log(spark, sf).repartition(6, "partition", "offset"))
    sink = FileSink(f"{root}/out")
    jobs.start_log_split(spark, topic, sink, f"{root}/checkpoint", trigger=jobs.ONCE).awaitTermination()
    return sink.read(spark).select("topic", "key", "value")


def _progress(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The progress table of a log split over half the topic, restarted for the rest."""
    root = scratch_dir(spark, name)
    halves, _ = _halves(env.app_log(spark, sf))
    topic = ReplayTopic(f"{root}/topic", LOG_TOPIC, partitions=env.LOG_PARTITIONS)
    for half in halves:
        topic.append(half)
        # A listener a run, as after a restart of the driver: the table is all that is left of the one before.
        listener = progress.ProgressListener(spark, f"{root}/progress")
        spark.streams.addListener(listener)
        try:
            query = jobs.start_log_split(spark, topic, FileSink(f"{root}/out"), f"{root}/checkpoint", trigger=jobs.ONCE)
            query.awaitTermination()
            listener.settled(query)
        finally:
            spark.streams.removeListener(listener)
    return listener.rows()


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What each batch of a restarted log split has read, per partition."""
    return _progress(spark, sf, "stream_progress").select("batch", "topic", "partition", "from_offset", "to_offset", "rows", "late_rows")


def offset_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Where a group that has read the whole topic stands, by the progress table of its stream."""
    return progress.positions(_progress(spark, sf, "offset_progress")).select(
        "topic", F.lit(jobs.LOG_GROUP).alias("group_id"), "partition", "next_offset"
    )


def log_counts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """What a log split over a damaged topic counts per batch: records, verdicts, messages."""
    root = scratch_dir(spark, "log_counts")
    halves, _ = _halves(env.damaged_app_log(spark, sf))
    topic, sink = ReplayTopic(f"{root}/topic", LOG_TOPIC), FileSink(f"{root}/out")
    counts = jobs.count_log(spark, f"{root}/counts")
    _replayed(
        lambda: jobs.start_log_split(spark, topic, sink, f"{root}/checkpoint", trigger=jobs.ONCE, counts=counts),
        topic.append, halves,
    )
    return counts.rows().filter("n > 0").select("batch", "step", "name", "n")


def cdc_counts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """What a change split counts per batch: records, data changes, facts and dimension rows."""
    root = scratch_dir(spark, "cdc_counts")
    log = env.change_log(spark, sf)
    topic, dims = ReplayTopic(f"{root}/topic", DB_TOPIC), KeyedTable(spark, f"{root}/dims")
    append = topic.dealt(log, F.col("partition") >= 2)
    counts = jobs.count_log(spark, f"{root}/counts")
    _replayed(
        lambda: jobs.start_change_split(
            spark, topic, lambda: env.control(spark), FileSink(f"{root}/out"), dims, f"{root}/checkpoint",
            trigger=jobs.ONCE, counts=counts,
        ),
        append, [0, 1],
    )
    return counts.rows().filter("n > 0").select("batch", "step", "name", "n")


def dim_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The newest dimension images from the state of a stream that was stopped after the inserts and restarted."""
    root = scratch_dir(spark, "dim_state")
    log = env.change_log(spark, sf, only=("supplier_info", *env.DIM_TABLES))
    step = F.shiftright("offset", env.STEP_BITS)
    topic = ReplayTopic(f"{root}/topic", DB_TOPIC)
    _replayed(
        lambda: dim_state.start_dim_state(
            spark, topic, env.control(spark), f"{root}/checkpoint", trigger=jobs.ONCE,
            partitions=spark.sparkContext.defaultParallelism,
        ),
        topic.append, [log.filter(step == 0), log.filter(step > 0)],
    )
    rows = dim_state.dim_state(spark, f"{root}/checkpoint")
    return rows.select(dim_key(F.col("space"), F.col("id")).alias("dim_key"), "op", "data")


def sink_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Fact messages keyed by row id, through the topic sink."""
    sink = FileSink(scratch_dir(spark, "sink_keyed"))
    sink.write(cr.change_messages(_routed(spark, sf), key_by_id=True), "batch", 0)
    return sink.read(spark).select("topic", "key", "value")


def _held(sink: FileSink, dims: KeyedTable, spark: SparkSession) -> DataFrame:
    """Facts and dimension rows as one result."""
    facts = sink.read(spark).select(F.lit("fact").alias("kind"), F.col("topic").alias("name"), "value")
    rows = dims.current().select(
        F.lit("dim").alias("kind"), dim_key(F.col("space"), F.col("id")).alias("name"),
        F.col("data").alias("value"),
    )
    return facts.unionByName(rows)


def cdc_split_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The change split in three restarts: inserts, then updates, then deletes."""
    root = scratch_dir(spark, "cdc_split")
    topic, sink = ReplayTopic(f"{root}/topic", DB_TOPIC), FileSink(f"{root}/out")
    append = topic.dealt(env.change_log(spark, sf), F.shiftright("offset", env.STEP_BITS))
    dims = KeyedTable(spark, f"{root}/dims")
    _replayed(
        lambda: jobs.start_change_split(
            spark, topic, lambda: env.control(spark), sink, dims, f"{root}/checkpoint",
            trigger=jobs.ONCE,
        ),
        append, [0, 1, 2],
    )
    return _held(sink, dims, spark)


FIRST_CONTROL = [("fact", "order_info"), ("dim", "user_info")]


def control_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Routing rules changed between two batches of one running query."""
    root = scratch_dir(spark, "control_refresh")
    log = env.change_log(spark, sf)
    topic, sink = ReplayTopic(f"{root}/topic", DB_TOPIC), FileSink(f"{root}/out")
    dims = KeyedTable(spark, f"{root}/dims")
    rules = env.control(spark)
    append = topic.dealt(log, F.col("partition") >= 2)
    steps = [(0, spark.createDataFrame(FIRST_CONTROL, rules.schema)), (1, rules)]
    query = None
    try:
        for part, control in steps:
            publish_control(control, f"{root}/control")
            append(part)
            if query is None:
                query = jobs.start_change_split(
                    spark, topic, control_files(spark, f"{root}/control"), sink, dims,
                    f"{root}/checkpoint", trigger={"processingTime": "0 seconds"},
                )
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    return _held(sink, dims, spark)


def _messages(rows: DataFrame, topic: str) -> DataFrame:
    """Typed rows with a ``created`` time as records of one topic."""
    return rows.select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.col("created").alias("timestamp"), F.lit(None).cast("string").alias("key"),
        F.to_json(env.payload(rows)).alias("value"),
    )


def order_wide_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and details merged as streams, in two batches by order time."""
    root = scratch_dir(spark, "order_wide")
    info, detail = env.order_info(spark, sf), env.order_detail(spark, sf)
    first, last = info.agg(F.min("created"), F.max("created")).first()
    cut = F.lit(first + (last - first) / 2)
    names = ("DWD_ORDER_INFO_I_1018", "DWD_ORDER_DETAIL_I_1018")
    topics = [ReplayTopic(f"{root}/{n}", n) for n in names]

    def append(part: int) -> None:
        for rows, name, topic in zip((info, detail), names, topics):
            early = F.col("created") <= cut
            topic.append(_messages(rows.filter(early if part == 0 else ~early), name))

    _replayed(
        lambda: derived.start_order_wide(
            spark, *topics, f"{root}/out", f"{root}/checkpoint", trigger=jobs.ONCE,
            partitions=spark.sparkContext.defaultParallelism,
        ),
        append, [0, 1],
    )
    return spark.read.parquet(f"{root}/out").drop("run", "batch_id")


def order_merge_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two-sided merge of four batches: early records, later ones, late ones, and one that ends the wait.

    Orders with an id divisible by 43 are never sent; early ones by 41 come late, with their details.
    """
    root = scratch_dir(spark, "order_merge")
    info, detail = env.order_info(spark, sf), env.order_detail(spark, sf)
    first, last = info.agg(F.min("created"), F.max("created")).first()
    early = F.col("created") <= F.lit(first + (last - first) / 2)
    held = early & (F.col("_order") % 41 == 0)
    sides = [info.withColumn("_order", F.col("id")).filter("id % 43 <> 0"), detail.withColumn("_order", F.col("order_id"))]
    names = ("DWD_ORDER_INFO_I_1018", "DWD_ORDER_DETAIL_I_1018")
    topics = [ReplayTopic(f"{root}/{n}", n) for n in names]
    end = spark.createDataFrame([(-1, -1, last + timedelta(days=30))], "id long, order_id long, created timestamp")

    def append(part) -> None:
        for rows, name, topic in zip(sides, names, topics):
            topic.append(_messages(end if part is None else rows.filter(part).drop("_order"), name))

    _replayed(
        lambda: wide.start_order_merge(
            spark, *topics, f"{root}/out", f"{root}/checkpoint", trigger=jobs.ONCE,
            partitions=spark.sparkContext.defaultParallelism,
        ),
        append, [early & ~held, ~early, held, None],
    )
    columns = ["kind", "order_id", "detail_id", "order_status", "total_amount", "split_total_amount", "sku_name", "create_time"]
    done = wide.merged(spark, f"{root}/out").filter("order_id >= 0").select(*columns)
    out = wide.left_out(spark, f"{root}/out")
    number = lambda name: F.get_json_object("value", f"$.{name}").cast("bigint")
    is_order = F.col("side") == wide.ORDER
    late = out.select(
        F.concat_ws("_", "reason", "side").alias("kind"), F.when(is_order, number("id")).otherwise(number("order_id")).alias("order_id"),
        F.when(is_order, 0).otherwise(number("id")).alias("detail_id"),
        *(F.lit(None).cast(done.schema[c].dataType).alias(c) for c in columns[3:]),
    )
    return done.unionByName(late)


def _page_messages(spark: SparkSession, sf: str) -> DataFrame:
    pages = lr.page_log(_log(spark, sf), carry=("partition", "offset"))
    return pages.select(
        F.lit(lr.LogTopics.page).alias("topic"), "partition", "offset",
        F.timestamp_millis("ts").alias("timestamp"), F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*PAGE_LOG.names)).alias("value"),
    )


def _dau_stream(spark: SparkSession, sf: str, dims: KeyedTable | None) -> DataFrame:
    root = scratch_dir(spark, "dau")
    # The middle of the app log: that of its pages would take a decoding of the whole log to find.
    halves, _ = _halves(_page_messages(spark, sf), env.app_log(spark, sf))
    topic = ReplayTopic(f"{root}/topic", lr.LogTopics.page)
    table = derived.dau_table(spark, f"{root}/table")
    _replayed(
        lambda: derived.start_daily_active(
            spark, topic, table, f"{root}/checkpoint", trigger=jobs.ONCE, dims=dims
        ),
        topic.append, halves,
    )
    return derived.daily_active(table)


def dau_stream(spark: SparkSession, sf: str) -> DataFrame:
    """First visits kept by a stream over page messages, in two batches."""
    return _dau_stream(spark, sf, None)


def dau_enrich_stream(spark: SparkSession, sf: str) -> DataFrame:
    """First visits kept by a stream, with columns looked up in the dimension table."""
    return _dau_stream(spark, sf, _dim_table(spark, sf))


def order_enrich_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Order messages enriched batch by batch from the dimension table."""
    root = scratch_dir(spark, "order_enrich")
    topic = ReplayTopic(f"{root}/topic", "DWD_ORDER_INFO_I_1018")
    halves, _ = _halves(_messages(env.order_info(spark, sf), topic.topic))
    dims, sink = _dim_table(spark, sf), FileSink(f"{root}/out")
    _replayed(
        lambda: derived.start_order_enrich(
            spark, topic, dims, sink, f"{root}/checkpoint", trigger=jobs.ONCE
        ),
        topic.append, halves,
    )
    return orders.decode_fact(sink.read(spark), ORDER_INFO)


QUERIES = {
    "parse_log": parse_log_query,
    "log_page": lambda spark, sf: lr.page_log(_log(spark, sf)),
    "log_display": lambda spark, sf: lr.page_display_log(_log(spark, sf)),
    "log_action": lambda spark, sf: lr.page_action_log(_log(spark, sf)),
    "log_start": lambda spark, sf: lr.start_log(_log(spark, sf)),
    "log_error": log_error,
    "log_unrouted": log_unrouted,
    "log_quarantine": log_quarantine,
    "log_page_json": log_page_json,
    "log_fanout": log_fanout,
    "parse_cdc": parse_cdc,
    "cdc_op_code": cdc_op_code,
    "cdc_fact": cdc_fact,
    "cdc_fact_topics": cdc_fact_topics,
    "cdc_dim": cdc_dim,
    "cdc_dim_latest": cdc_dim_latest,
    "cdc_fanout": cdc_fanout,
    "align_columns": align_columns,
    "page_to_dau": page_to_dau,
    "order_date_hour": order_date_hour,
    "order_enrich": order_enrich,
    "order_wide_inner": order_wide_inner,
    "order_wide_full": order_wide_full,
    "order_wide_enriched": order_wide_enriched,
    "dau_first_visit": dau_first_visit,
    "dau_enrich": dau_enrich,
    "source_topic": source_topic,
    "source_from_offsets": source_from_offsets,
    "resume_from_checkpoint": resume_from_checkpoint,
    "log_split_stream": log_split_stream,
    "offset_progress": offset_progress,
    "stream_progress": stream_progress,
    "log_counts_stream": log_counts_stream,
    "cdc_counts_stream": cdc_counts_stream,
    "dim_state_stream": dim_state_stream,
    "order_merge_stream": order_merge_stream,
    "sink_keyed": sink_keyed,
    "cdc_split_stream": cdc_split_stream,
    "control_refresh": control_refresh,
    "order_wide_stream": order_wide_stream,
    "order_enrich_stream": order_enrich_stream,
    "dau_stream": dau_stream,
    "dau_enrich_stream": dau_enrich_stream,
}

# Queries that run a stream when called.
STREAMING = (
    "source_topic", "resume_from_checkpoint", "log_split_stream", "cdc_split_stream", "control_refresh",
    "order_wide_stream", "order_enrich_stream", "dau_stream", "dau_enrich_stream", "offset_progress", "stream_progress",
    "log_counts_stream", "cdc_counts_stream", "dim_state_stream", "order_merge_stream",
)
