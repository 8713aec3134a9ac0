"""The jobs as streams: restarts, replays, start positions, options."""

import json

import pytest
from pyspark.sql import functions as F

from sluice.functions.align import align
from sluice.operators.daily_active import first_visits
from sluice.operators.log_routes import LogTopics, log_messages
from sluice.operators.orders import order_wide
from sluice.operators.parse import parse_log
from sluice.plans import envelopes
from sluice.schemas import CONTROL, DAU_INFO, ORDER_DETAIL, ORDER_INFO, PAGE_LOG
from sluice.session import scratch_dir
from sluice.sources.files import Files
from sluice.sources.keyed_table import KeyedTable
from sluice.sources.sinks import FileSink, KafkaSink
from sluice.sources.control import control_files, publish_control
from sluice.sources.topics import KafkaTopic, ReplayTopic, from_offsets, next_offsets, starting_offsets
from sluice.streaming import derived, jobs

LOG, DB = LogTopics.source, "ODS_BASE_DB_1018"


def page(n, mid="d"):
    return json.dumps({"common": {"mid": mid}, "page": {"page_id": str(n)}, "ts": n})


def pages_in(sink, spark):
    rows = sink.read(spark).filter(F.col("topic") == LogTopics.page).collect()
    return sorted(int(json.loads(r["value"])["page_id"]) for r in rows)


def test_restart_loses_and_repeats_nothing(spark, records):
    root = scratch_dir(spark, "restart")
    topic, sink = ReplayTopic(f"{root}/t", LOG, max_files_per_trigger=1), FileSink(f"{root}/out")
    for part in range(3):
        for file in range(2):
            first = part * 20 + file * 10
            topic.append(records([page(first + i) for i in range(10)], LOG, 0, first).coalesce(1))
        jobs.start_log_split(spark, topic, sink, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    assert pages_in(sink, spark) == list(range(60))
    assert sink.read(spark).select("batch_id").distinct().count() == 6


def test_failed_batch_is_taken_again(spark, records):
    """The sink writes and then the batch fails: the replay replaces its files."""
    root = scratch_dir(spark, "replay")
    topic, sink = ReplayTopic(f"{root}/t", LOG), FileSink(f"{root}/out")
    topic.append(records([page(i) for i in range(10)], LOG))

    class Failing:
        def write(self, messages, run, batch_id):
            sink.write(messages, run, batch_id)
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception):
        jobs.start_log_split(spark, topic, Failing(), f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    assert pages_in(sink, spark) == list(range(10))
    jobs.start_log_split(spark, topic, sink, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    assert pages_in(sink, spark) == list(range(10))


def test_new_checkpoint_does_not_overwrite(spark, records):
    root = scratch_dir(spark, "two")
    topic, sink = ReplayTopic(f"{root}/t", LOG), FileSink(f"{root}/out")
    topic.append(records([page(1)], LOG))
    for n in range(2):
        jobs.start_log_split(spark, topic, sink, f"{root}/cp{n}", trigger=jobs.ONCE).awaitTermination()
    assert pages_in(sink, spark) == [1, 1]


def test_fail_option_stops_the_query(spark, records):
    root = scratch_dir(spark, "fail")
    topic, sink = ReplayTopic(f"{root}/t", LOG), FileSink(f"{root}/out")
    topic.append(records([page(1), "nope"], LOG))
    with pytest.raises(Exception):
        jobs.start_log_split(
            spark, topic, sink, f"{root}/cp", on_malformed="fail", trigger=jobs.ONCE
        ).awaitTermination()
    # Nothing was committed: the record is met again once it can be set aside.
    jobs.start_log_split(spark, topic, sink, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    assert sorted(r["topic"] for r in sink.read(spark).collect()) == [LogTopics.page, LogTopics.quarantine]


def test_offsets_of_records(spark, records):
    rows = records([page(i) for i in range(4)], LOG, 0).union(records([page(9)] * 2, LOG, 1, first=5))
    ends = {(r["topic"], r["partition"]): r["next_offset"] for r in next_offsets(rows).collect()}
    assert ends == {(LOG, 0): 4, (LOG, 1): 7}
    starts = spark.createDataFrame([(LOG, 0, 3)], "topic string, partition int, next_offset long")
    assert sorted((r["partition"], r["offset"]) for r in from_offsets(rows, starts).collect()) == [(0, 3), (1, 5), (1, 6)]


def test_half_written_control_loses_nothing(spark, records):
    """No complete rules: the batch fails and waits. A half-written newer set: the last whole one counts."""
    root = scratch_dir(spark, "control")
    topic, sink, dims = ReplayTopic(f"{root}/t", DB), FileSink(f"{root}/out"), KeyedTable(spark, f"{root}/dims")
    change = lambda n: json.dumps({"type": "insert", "table": "a", "data": {"id": n}})
    rules = spark.createDataFrame([("fact", "a")], CONTROL)

    def run():
        jobs.start_change_split(
            spark, topic, control_files(spark, f"{root}/control"), sink, dims, f"{root}/cp", trigger=jobs.ONCE
        ).awaitTermination()

    topic.append(records([change(1)], DB))
    with pytest.raises(Exception, match="no complete control table"):
        run()
    publish_control(rules, f"{root}/control")
    run()
    half = f"{root}/control/version=2"
    rules.limit(0).write.parquet(half)
    Files(spark, half).delete("_SUCCESS")
    topic.append(records([change(2)], DB, 0, 1))
    run()
    assert sorted(r["value"] for r in sink.read(spark).collect()) == ['{"id":1}', '{"id":2}']
    publish_control(rules.limit(0), f"{root}/control")  # an empty set is a decision
    topic.append(records([change(3)], DB, 0, 2))
    run()
    assert sink.read(spark).count() == 2


def test_kafka_options():
    topic = KafkaTopic("h:9092", "t", {1: 5, 0: 7}, min_partitions=9, max_offsets_per_trigger=100)
    assert topic.reader_options() == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t",
        "startingOffsets": '{"t": {"0": 7, "1": 5}}', "minPartitions": "9", "maxOffsetsPerTrigger": "100",
    }
    assert KafkaTopic("h", "t").reader_options()["startingOffsets"] == "latest"
    assert starting_offsets("t", "earliest") == "earliest"
    assert starting_offsets("t", {1: 5}, partitions=3) == '{"t": {"0": -2, "1": 5, "2": -2}}'
    assert KafkaSink("h").writer_options() == {
        "kafka.bootstrap.servers": "h", "kafka.enable.idempotence": "true", "kafka.acks": "all",
    }


def test_delete_then_lookup(spark, records):
    root = scratch_dir(spark, "delete")
    topic = ReplayTopic(f"{root}/t", DB)
    control = spark.createDataFrame([("dim", "user_info")], CONTROL)
    dims = KeyedTable(spark, f"{root}/dims")
    for n, kind in enumerate(("insert", "delete")):
        topic.append(records([json.dumps({"type": kind, "table": "user_info", "data": {"id": 1, "n": n}})], DB, 0, n))
        jobs.start_change_split(
            spark, topic, lambda: control, FileSink(f"{root}/out"), dims, f"{root}/cp", trigger=jobs.ONCE
        ).awaitTermination()
    (row,) = dims.current("DIM:USER_INFO").collect()
    assert (row["op"], json.loads(row["data"])) == ("D", {"id": 1, "n": 1})
    assert KeyedTable(spark, dims.path, on_delete="remove").current().count() == 0


def test_batch_equals_stream_on_a_third_in_one_key(spark, records):
    """A third of all records from one device, in one partition."""
    values = [page(i, "hot" if i % 3 == 0 else f"d{i}") for i in range(900)]
    root = scratch_dir(spark, "hot")
    topic, sink = ReplayTopic(f"{root}/t", LOG), FileSink(f"{root}/out")
    rows = records(values, LOG)
    topic.append(rows)
    jobs.start_log_split(spark, topic, sink, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    batch = log_messages(parse_log(rows)).select("topic", "value")
    assert sorted(sink.read(spark).select("topic", "value").collect()) == sorted(batch.collect())


def test_earlier_view_in_a_later_batch_replaces_the_first(spark, records):
    root = scratch_dir(spark, "dau")
    topic = ReplayTopic(f"{root}/t", LogTopics.page)
    table = derived.dau_table(spark, f"{root}/table")
    for n, ts in enumerate((5000, 3000, 9000)):
        topic.append(records([json.dumps({"mid": "m", "page_id": str(n), "ts": ts})], LogTopics.page, 0, n))
        derived.start_daily_active(spark, topic, table, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    (row,) = derived.daily_active(table, "1970-01-01").collect()
    assert (row["page_id"], row["ts"], row["hr"]) == ("1", 3000, "00")


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_damaged_topic_loses_no_record(spark):
    """Every record is quarantined, unrouted or gives at least one message."""
    from sluice.operators import log_routes as lr

    parsed = parse_log(envelopes.damaged_app_log(spark, "/root/testdata/sf0.001")).persist()
    try:
        key = ["partition", "offset"]
        out = lr.split_log(parsed).select(*key).distinct()
        silent = lr.unrouted_log(parsed).select(*key)
        assert out.intersect(silent).count() == 0
        assert out.union(silent).count() == parsed.count() == 1000
    finally:
        parsed.unpersist()


def test_hot_order_in_the_stream_equals_batch(spark):
    """One order with a third of all details, merged over several batches."""
    root = scratch_dir(spark, "wide")
    info = align(spark.range(60).select("id", F.col("id").cast("double").alias("total_amount")), ORDER_INFO)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 55)
    detail = align(spark.range(600).select("id", hot.alias("order_id")), ORDER_DETAIL)
    sides = [ReplayTopic(f"{root}/{n}", n, max_files_per_trigger=2) for n in ("orders", "details")]
    for topic, rows in zip(sides, (info, detail)):
        topic.append(rows.repartition(4).select(
            F.lit(topic.topic).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
            F.timestamp_seconds(1700000000 + F.col("id") % 60).alias("timestamp"),
            F.lit(None).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"),
        ))
    derived.start_order_wide(
        spark, *sides, f"{root}/out", f"{root}/cp", trigger=jobs.ONCE, partitions=4
    ).awaitTermination()
    found = spark.read.parquet(f"{root}/out")
    expected = order_wide(info, detail)
    assert found.count() == expected.count() == 600
    names = [c for c in expected.columns if c not in ("create_date", "create_hour")]
    assert found.select(*names).exceptAll(expected.select(*names)).count() == 0


def test_wide_stream_needs_both_sides_near_in_time(spark, records):
    root = scratch_dir(spark, "near")
    sides = [ReplayTopic(f"{root}/{n}", n) for n in ("orders", "details")]
    day = 86400
    for topic, values in zip(sides, (['{"id":1}', '{"id":2}'], ['{"id":10,"order_id":1}', '{"id":20,"order_id":2}'])):
        at = F.timestamp_seconds(F.when(F.col("offset") == 0, 1000).otherwise(
            1000 if topic.topic == "orders" else 1000 + 2 * day
        ))
        topic.append(records(values, topic.topic).withColumn("timestamp", at))
    derived.start_order_wide(
        spark, *sides, f"{root}/out", f"{root}/cp", trigger=jobs.ONCE, partitions=2
    ).awaitTermination()
    assert [r["detail_id"] for r in spark.read.parquet(f"{root}/out").collect()] == [10]


def test_unmatched_details_come_out_and_late_ones_are_counted(spark, records):
    root, day = scratch_dir(spark, "unmatched"), 86400
    sides = [ReplayTopic(f"{root}/{n}", n) for n in ("orders", "details")]
    steps = [
        (['{"id":1}'], ['{"id":10,"order_id":1}', '{"id":20,"order_id":2}'], 1000),
        (['{"id":3}'], ['{"id":30,"order_id":3}'], 1000 + 9 * day),
        (['{"id":4}'], ['{"id":40,"order_id":4}'], 2000),  # late by days
    ]
    late = 0
    for n, (orders, details, at) in enumerate(steps):
        for topic, values in zip(sides, (orders, details)):
            rows = records(values, topic.topic, 0, 10 * n)
            topic.append(rows.withColumn("timestamp", F.timestamp_seconds(F.lit(at))))
        query = derived.start_order_wide(
            spark, *sides, f"{root}/out", f"{root}/cp", trigger=jobs.ONCE, partitions=2, keep_unmatched=True
        )
        query.awaitTermination()
        late += derived.late_rows(query)
    found = {(r["detail_id"], r["order_id"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert found == {(10, 1), (20, 2), (30, 3)} and late > 0


def test_undated_views_count_for_no_day(spark, records):
    root = scratch_dir(spark, "undated")
    topic = ReplayTopic(f"{root}/t", LogTopics.page)
    topic.append(records(['{"mid":"m","page_id":"a"}', '{"mid":"m","page_id":"b","ts":5}'], LogTopics.page))
    table = derived.dau_table(spark, f"{root}/table")
    derived.start_daily_active(spark, topic, table, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    assert [r["page_id"] for r in derived.daily_active(table).collect()] == ["b"]
    pages = topic.batch(spark).select(F.from_json("value", PAGE_LOG).alias("p")).select("p.*")
    assert [r["page_id"] for r in first_visits(pages).collect()] == ["b"]


def view(mid, ts, **more):
    return json.dumps({"mid": mid, "page_id": "p", "ts": ts, **more})


def test_a_clock_far_ahead_silences_nobody(spark, records):
    root = scratch_dir(spark, "ahead")
    topic, table = ReplayTopic(f"{root}/t", LogTopics.page), derived.dau_table(spark, f"{root}/table")
    day = 86_400_000
    for n, (mid, ts) in enumerate([("wrong", 400 * day), ("honest", day), ("late", 5)]):
        topic.append(records([view(mid, ts)], LogTopics.page, 0, n))
        derived.start_daily_active(spark, topic, table, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    found = {(r["mid"], r["dt"]) for r in derived.daily_active(table).collect()}
    assert found == {("wrong", "1971-02-05"), ("honest", "1970-01-02"), ("late", "1970-01-01")}


def test_replay_without_the_checkpoint_commit(spark, records):
    """The table took the batch, the checkpoint did not: the restart goes on."""
    root = scratch_dir(spark, "commit")
    topic, table = ReplayTopic(f"{root}/t", LogTopics.page), derived.dau_table(spark, f"{root}/table")
    for n in range(2):
        topic.append(records([view(f"m{n}", 5)], LogTopics.page, 0, n))
        derived.start_daily_active(spark, topic, table, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
        files = Files(spark, f"{root}/cp/commits")
        for name in files.names():
            if name in ("0", ".0.crc"):
                files.delete(name)
    topic.append(records([view("m2", 5)], LogTopics.page, 0, 2))
    derived.start_daily_active(spark, topic, table, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    assert sorted(r["mid"] for r in derived.daily_active(table).collect()) == ["m0", "m1", "m2"]


def test_half_of_all_views_without_a_user(spark, records):
    """Views of nobody are spread over the tasks of the lookup, and come out once."""
    from sluice.operators.daily_active import enrich_dau
    from sluice.operators.lookup import provinces, users

    facts = spark.range(4000).select(
        F.concat(F.lit("m"), "id").alias("mid"), F.when(F.col("id") % 2 == 0, (F.col("id") % 50).cast("string")).alias("user_id")
    )
    dims = spark.createDataFrame([(str(i), json.dumps({"id": i, "gender": "F", "age": i})) for i in range(1, 50)], "id string, data string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich_dau(align(facts, DAU_INFO), provinces(dims.limit(0)), users(dims))
        rows = joined.select("mid", "user_gender", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len({r["mid"] for r in rows}) == len(rows) == 4000
    assert sum(r["user_gender"] == "F" for r in rows) == 1920
    root = scratch_dir(spark, "nobody")
    topic, table = ReplayTopic(f"{root}/t", LogTopics.page), derived.dau_table(spark, f"{root}/table")
    people = KeyedTable(spark, f"{root}/dims")
    people.upsert(dims.select(F.lit("DIM:USER_INFO").alias("space"), "id", "data", F.lit("I").alias("op"), F.lit(0).alias("src_partition"), F.lit(1).cast("long").alias("src_offset")), "r", 0)
    topic.append(records([view(f"m{i}", i, user_id=str(i) if i % 2 else None) for i in range(40)], LogTopics.page))
    derived.start_daily_active(spark, topic, table, f"{root}/cp", trigger=jobs.ONCE, dims=people).awaitTermination()
    assert sorted(r["user_gender"] or "" for r in derived.daily_active(table).collect()) == [""] * 20 + ["F"] * 20


def test_daily_active_opens_its_own_spaces_only(spark, records):
    root = scratch_dir(spark, "spaces")
    table = derived.dau_table(spark, f"{root}/table")
    other = spark.createDataFrame([("DIM:A", "1", "{}", "I", 0, 1, 5)], "space string, id string, data string, op string, src_partition int, src_offset long, at long")
    table.upsert(other, "r", 0)
    topic = ReplayTopic(f"{root}/t", LogTopics.page)
    topic.append(records([view("m", 5)], LogTopics.page))
    derived.start_daily_active(spark, topic, table, f"{root}/cp", trigger=jobs.ONCE).awaitTermination()
    assert [r["mid"] for r in derived.daily_active(table).collect()] == ["m"]
