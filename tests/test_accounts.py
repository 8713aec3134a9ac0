"""What streams tell about themselves: progress, counts, newest images in state, the two-sided merge."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.log_routes import LogTopics
from sluice.operators.orders import order_wide
from sluice.functions.align import align
from sluice.schemas import CONTROL, ORDER_DETAIL, ORDER_INFO
from sluice.session import scratch_dir
from sluice.sources.keyed_table import KeyedTable
from sluice.sources.sinks import FileSink
from sluice.sources.topics import ReplayTopic
from sluice.streaming import batch_log, dim_state, jobs, progress, wide

DB = "ODS_BASE_DB_1018"


# ---- batch log


@pytest.fixture
def log(spark, monkeypatch):
    monkeypatch.setattr(batch_log, "ROLL", 4)
    return jobs.count_log(spark, scratch_dir(spark, "log"))


def line(n):
    return [{"step": "s", "name": "x", "n": n}]


def test_batches_are_taken_once_and_rolled(log):
    assert log.rows().count() == 0 and log.last("q") == []
    for n in range(11):
        assert log.put("q", n, line(n)) and not log.put("q", n, line(-1))
    log.put("r", 0, line(7))
    assert sorted((r["query"], r["batch"], r["n"]) for r in log.rows().collect()) == [*(("q", n, n) for n in range(11)), ("r", 0, 7)]
    names = [n for n in log.files.names("q") if n.endswith(".json") and n[0] != "."]
    assert len(names) == 5 and log.last("q")[0]["n"] == 10


def test_a_crash_while_rolling_counts_nothing_twice(log):
    for n in range(3):
        log.put("q", n, line(n))
    delete, log.files.delete = log.files.delete, lambda name: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        log.put("q", 3, line(3))
    log.files.delete = delete
    assert sorted(r["n"] for r in log.rows("q").collect()) == [0, 1, 2, 3]
    assert not log.put("q", 2, line(9)) and not log.put("q", 3, line(9))


def test_waiting_for_a_batch_that_does_not_come(log):
    with pytest.raises(TimeoutError):
        log.wait_for("q", 0, seconds=0.2)


# ---- progress

KAFKA = {
    "id": "q", "runId": "r1", "timestamp": "t", "batchId": 3, "stateOperators": [{"numRowsDroppedByWatermark": 2}, {}],
    "sources": [{"description": "KafkaV2", "startOffset": {"a": {"0": 5, "1": 7}}, "endOffset": {"a": {"0": 9, "1": 7, "2": 4}}, "numInputRows": 8}],
}


def test_kafka_offsets_become_ranges():
    found = [(r["topic"], r["partition"], r["first"], r["to_offset"], r["rows"]) for r in progress.ranges(KAFKA)]
    assert found == [("a", 0, 5, 9, 4), ("a", 2, 0, 4, 4)]
    text = {**KAFKA, "sources": [{**KAFKA["sources"][0], "startOffset": None, "endOffset": json.dumps({"a": {"0": 2}})}]}
    assert [r["to_offset"] for r in progress.ranges(text)] == [2]
    files = {"sources": [{"description": "files", "startOffset": {"logOffset": 1}, "endOffset": {"logOffset": 3}, "numInputRows": 5}]}
    assert progress.ranges(files) == [{"topic": "files", "partition": -1, "first": 2, "to_offset": 4, "rows": 5}]
    assert progress.late_rows(KAFKA) == 2


def test_a_lost_report_leaves_no_gap(spark):
    path = scratch_dir(spark, "progress")

    def report(batch, start, end):
        return {**KAFKA, "batchId": batch, "sources": [{"description": "k", "startOffset": {"a": {"0": start}}, "endOffset": {"a": {"0": end}}, "numInputRows": 1}]}

    first = progress.ProgressListener(spark, path)
    assert first.take(report(0, 0, 5)) and not first.take(report(0, 0, 5))
    second = progress.ProgressListener(spark, path)  # the report of batch 1, 5 to 8, went with the driver
    assert second.take(report(2, 8, 9)) and not second.take(report(3, 9, 9) | {"stateOperators": []})
    rows = second.rows("q")
    assert sorted((r["batch"], r["from_offset"], r["to_offset"], r["late_rows"]) for r in rows.collect()) == [(0, 0, 5, 2), (2, 5, 9, 2)]
    assert progress.gaps(rows).count() == 0 and progress.positions(rows).collect()[0]["next_offset"] == 9


# ---- counts


def test_counts_take_the_pass_that_writes(spark, records):
    root = scratch_dir(spark, "counts")
    topic, sink = ReplayTopic(f"{root}/t", LogTopics.source), FileSink(f"{root}/out")
    page = '{"common":{"mid":"m"},"page":{"page_id":"p"},"ts":1}'
    topic.append(records([page, page, "nope", '{"page":{}}', '{"common":{}}', '{"common":{},"err":{}}'], LogTopics.source))
    counts = jobs.count_log(spark, f"{root}/counts")
    read = []

    class Watched:
        def write(self, messages, run, batch_id):
            read.append(messages._jdf.queryExecution().executedPlan().toString().count("from_json("))
            sink.write(messages, run, batch_id)

    for _ in range(2):
        jobs.start_log_split(spark, topic, Watched(), f"{root}/cp", trigger=jobs.ONCE, counts=counts).awaitTermination()
    found = {(r["step"], r["name"]): r["n"] for r in counts.rows().filter("n > 0").collect()}
    assert found == {
        ("judged", "read"): 6, ("judged", "routed"): 2, ("judged", "malformed"): 1, ("judged", "no_common"): 1,
        ("judged", "unrouted"): 1, ("judged", "error"): 1, ("sent", LogTopics.page): 2, ("sent", LogTopics.error): 1,
        ("sent", LogTopics.quarantine): 2,
    }
    assert read == [1]  # decoded once, in the one pass of the one batch


def test_change_counts_by_reason(spark, records):
    root = scratch_dir(spark, "counts")
    topic, dims = ReplayTopic(f"{root}/t", DB), KeyedTable(spark, f"{root}/dims")
    change = lambda table, kind="insert", data={"id": 1}: json.dumps({"type": kind, "table": table, "data": data})  # noqa: E731, B006
    topic.append(records([change("a"), change("b"), change("b", data={"x": 1}), change("a", data=None), "nope", change("c"), change("a", "table-create")], DB))
    control = spark.createDataFrame([("fact", "a"), ("dim", "b")], CONTROL)
    counts = jobs.count_log(spark, f"{root}/counts")
    jobs.start_change_split(spark, topic, lambda: control, FileSink(f"{root}/out"), dims, f"{root}/cp", trigger=jobs.ONCE, counts=counts).awaitTermination()
    found = {(r["step"], r["name"]): r["n"] for r in counts.rows().filter("n > 0").collect()}
    assert found == {
        ("read", "read"): 7, ("coded", "changes"): 5, ("judged", "routed"): 5, ("judged", "fact"): 1, ("judged", "dim"): 1,
        ("judged", "malformed"): 1, ("judged", "no_data"): 1, ("judged", "no_id"): 1,
    }


# ---- newest images in state


def test_state_keeps_the_newest_image(spark, records):
    root = scratch_dir(spark, "state")
    topic, control = ReplayTopic(f"{root}/t", DB), spark.createDataFrame([("dim", "a"), ("dim", "b")], CONTROL)
    change = lambda n, kind, rev, table="a": json.dumps({"type": kind, "table": table, "data": {"id": n, "rev": rev}})
    parts = [
        records([change(1, "insert", 0), change(2, "insert", 0), change(1, "update", 1)], DB),
        records([change(2, "delete", 1), change(3, "insert", 0, "b"), "nope"], DB, 0, 10),
        records([change(1, "update", -1)], DB, 1, 1),  # another partition, a smaller offset
    ]
    for part in parts:
        topic.append(part)
        dim_state.start_dim_state(spark, topic, control, f"{root}/cp", trigger=jobs.ONCE, partitions=2).awaitTermination()
    read = lambda **o: {(r["space"], r["id"]): (r["op"], json.loads(r["data"])["rev"]) for r in dim_state.dim_state(spark, f"{root}/cp", **o).collect()}
    assert read() == {("DIM:A", "1"): ("U", 1), ("DIM:A", "2"): ("D", 1), ("DIM:B", "3"): ("I", 0)}
    assert set(read(on_delete="remove")) == {("DIM:A", "1"), ("DIM:B", "3")}
    with pytest.raises(ValueError):
        dim_state.dim_state(spark, f"{root}/cp", on_delete="maybe")


# ---- two-sided merge

DAY = 86_400


def test_every_record_of_both_sides_is_accounted_for(spark):
    """Random orders and details over back-to-back batches: each is matched, alone or left out, and once."""
    root, r = scratch_dir(spark, "merge"), random.Random(3)
    sides = [ReplayTopic(f"{root}/{n}", n, max_files_per_trigger=1) for n in ("orders", "details")]
    sent, clock, schema = ({}, {}), 1_000_000, "topic string, partition int, offset long, key string, value string, s long"

    def append(side, values):
        rows = []
        for value, at in values:
            rows.append((sides[side].topic, 0, len(sent[side]), None, value, at))
            sent[side][len(sent[side])] = value
        sides[side].append(spark.createDataFrame(rows, schema).withColumn("timestamp", F.timestamp_seconds("s")).coalesce(1))

    def run():
        wide.start_order_merge(spark, *sides, f"{root}/out", f"{root}/cp", trigger=jobs.ONCE, partitions=3, salts=3).awaitTermination()

    for part in range(2):
        for _ in range(3):
            clock += r.choice([0, DAY // 2, 2 * DAY, 3 * DAY])
            for side in (0, 1):
                values = []
                for i in range(8):
                    at = clock + r.randrange(-3 * 3600, 3600) - (5 * DAY if r.random() < 0.15 else 0)
                    own, order = len(sent[side]) + i, r.randrange(20)
                    value = json.dumps({"id": 1000 + own, "order_id": order} if side else {"id": order, "order_status": str(own)})
                    values.append((value if r.random() < 0.95 else "{nope", at if r.random() < 0.95 else None))
                append(side, values)
        run()
    for side in (0, 1):
        append(side, [(json.dumps({"id": -1, "order_id": -1}), clock + 100 * DAY)])
    run()
    merged, left = wide.merged(spark, f"{root}/out").filter("order_id >= 0").collect(), wide.left_out(spark, f"{root}/out").collect()
    out = [{x["offset"] for x in left if x["side"] == side} for side in (wide.ORDER, wide.DETAIL)]
    assert {x["reason"] for x in left} == {wide.LATE, wide.NO_TIME, wide.UNREADABLE}
    for x in left:
        assert x["value"] == sent[x["side"] == wide.DETAIL][x["offset"]]
    by_kind = lambda *kinds: [x for x in merged if x["kind"] in kinds]
    details = [x["detail_id"] - 1000 for x in by_kind(wide.DETAIL_ALONE)] + list({x["detail_id"] - 1000 for x in by_kind(wide.MATCHED)})
    assert sorted([*details, *out[1]]) == [o for o in sent[1] if '"id": -1' not in sent[1][o]]
    orders = [int(x["order_status"]) for x in by_kind(wide.ORDER_ALONE)] + list({int(x["order_status"]) for x in by_kind(wide.MATCHED)})
    assert sorted([*orders, *out[0]]) == [o for o in sent[0] if '"id": -1' not in sent[0][o]]
    pairs = [(x["order_status"], x["detail_id"]) for x in by_kind(wide.MATCHED)]
    assert pairs and len(pairs) == len(set(pairs))


def test_hot_order_in_the_two_sided_merge(spark):
    """One order with a third of all details, orders without any, and repeated messages of one of these."""
    root = scratch_dir(spark, "hot")
    info = align(spark.range(60).select("id"), ORDER_INFO)
    info = info.unionByName(info.filter("id = 59"))
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)
    detail = align(spark.range(600).select("id", hot.alias("order_id")), ORDER_DETAIL)
    sides = [ReplayTopic(f"{root}/{n}", n) for n in ("orders", "details")]
    last = F.lit(-1).cast("long")
    for at in (1_700_000_000, 1_800_000_000):
        for topic, rows in zip(sides, (info, detail)):
            if at > 1_700_000_000:  # what ends the wait, on both sides
                rows = rows.limit(1).withColumns({c: last for c in ("id", "order_id") if c in rows.columns})
            topic.append(rows.select(
                F.lit(topic.topic).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
                F.timestamp_seconds(F.lit(at)).alias("timestamp"), F.lit(None).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"),
            ))
        wide.start_order_merge(spark, *sides, f"{root}/out", f"{root}/cp", trigger=jobs.ONCE, partitions=4).awaitTermination()
    found = wide.merged(spark, f"{root}/out").filter("order_id >= 0")
    expected = order_wide(info, detail, "full")
    assert {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()} == {"matched": 600, "order_alone": 11}
    names = ["order_id", "detail_id", "sku_num", "total_amount"]
    assert found.select(*names).exceptAll(expected.select(*names)).count() == 0

