"""The command line, over files."""

import json

import pytest
from pyspark.sql import functions as F

from sluice import app
from sluice.operators.log_routes import LogTopics
from sluice.schemas import CONTROL
from sluice.session import scratch_dir
from sluice.sources.control import publish_control
from sluice.sources.keyed_table import KeyedTable
from sluice.sources.sinks import FileSink
from sluice.sources.topics import ReplayTopic
from sluice.streaming import derived, jobs
from sluice.streaming.dim_state import dim_state
from sluice.streaming.progress import ProgressListener
from sluice.streaming.wide import merged


def run(spark, *words):
    args = app.parser().parse_args(words)
    app.finish(spark, args, app.start(spark, args))


def test_log_split(spark, records):
    root = scratch_dir(spark, "app")
    ReplayTopic(f"{root}/t", "mine").append(records(['{"common":{},"start":{}}'], "mine", 2, 5))
    run(spark, "log-split", "--replay", f"{root}/t", "--topic", "mine",
        "--out", f"{root}/out", "--checkpoint", f"{root}/cp", "--once")
    (row,) = FileSink(f"{root}/out").read(spark).collect()
    assert (row["topic"], row["value"]) == (LogTopics.start, "{}")


def test_restart_with_default_options_loses_nothing(spark, records):
    root = scratch_dir(spark, "app")
    for n in range(3):
        ReplayTopic(f"{root}/t", LogTopics.source).append(
            records(['{"common":{},"start":{"entry":"%d"}}' % n] * 5, LogTopics.source, 0, 5 * n)
        )
        run(spark, "log-split", "--replay", f"{root}/t", "--out", f"{root}/out", "--checkpoint", f"{root}/cp", "--once")
    found = [json.loads(r["value"])["entry"] for r in FileSink(f"{root}/out").read(spark).collect()]
    assert sorted(found) == ["0"] * 5 + ["1"] * 5 + ["2"] * 5


def test_derived_jobs(spark, records):
    root = scratch_dir(spark, "app")
    page = json.dumps({"mid": "m", "page_id": "p", "ts": 5, "user_id": "1"})
    ReplayTopic(f"{root}/t", LogTopics.page).append(records([page], LogTopics.page))
    order, detail = '{"id":1,"user_id":1,"province_id":2}', '{"id":7,"order_id":1}'
    for topic, value in (("DWD_ORDER_INFO_I_1018", order), ("DWD_ORDER_DETAIL_I_1018", detail)):
        at = F.timestamp_seconds(F.lit(1_700_000_000))
        ReplayTopic(f"{root}/t", topic).append(records([value], topic).withColumn("timestamp", at))
    common = ("--replay", f"{root}/t", "--once", "--checkpoint")
    run(spark, "daily-active", "--dau", f"{root}/dau", "--dims", f"{root}/dims", *common, f"{root}/c1")
    (row,) = derived.daily_active(derived.dau_table(spark, f"{root}/dau")).collect()
    assert (row["mid"], row["dt"]) == ("m", "1970-01-01")
    run(spark, "order-enrich", "--dims", f"{root}/dims", "--out", f"{root}/out", *common, f"{root}/c2")
    assert [r["key"] for r in FileSink(f"{root}/out").read(spark).collect()] == ["1"]
    run(spark, "order-wide", "--topic", "DWD_ORDER_INFO_I_1018", "--wide", f"{root}/wide", "--state-partitions", "2", *common, f"{root}/c3")
    assert [r["detail_id"] for r in spark.read.parquet(f"{root}/wide").collect()] == [7]


def test_change_split(spark, records):
    root = scratch_dir(spark, "app")
    change = json.dumps({"type": "insert", "table": "a", "data": {"id": 1}})
    ReplayTopic(f"{root}/t", "ODS_BASE_DB_1018").append(records([change], "ODS_BASE_DB_1018"))
    publish_control(spark.createDataFrame([("fact", "a"), ("dim", "a")], CONTROL), f"{root}/control")
    run(spark, "change-split", "--replay", f"{root}/t", "--out", f"{root}/out",
        "--checkpoint", f"{root}/cp", "--control", f"{root}/control", "--dims", f"{root}/dims",
        "--key-by-id", "--once")
    rows = FileSink(f"{root}/out").read(spark).select("topic", "key", "value").collect()
    assert rows == [("DWD_A_I_1018", "1", '{"id":1}')]
    dims = KeyedTable(spark, f"{root}/dims").current().select(F.concat_ws(":", "space", "id")).collect()
    assert dims == [("DIM:A:1",)]


def test_accounts_and_state_from_the_command_line(spark, records):
    root = scratch_dir(spark, "app")
    change = json.dumps({"type": "insert", "table": "a", "data": {"id": 1}})
    ReplayTopic(f"{root}/t", "ODS_BASE_DB_1018").append(records([change, "nope"], "ODS_BASE_DB_1018", 0, 5))
    ReplayTopic(f"{root}/t", derived.ENRICHED_ORDERS).append(records(['{"id":1}'], derived.ENRICHED_ORDERS).withColumn("timestamp", F.timestamp_seconds(F.lit(5))))
    ReplayTopic(f"{root}/t", "DWD_ORDER_DETAIL_I_1018").append(records(['{"id":7,"order_id":1}'], "DWD_ORDER_DETAIL_I_1018").withColumn("timestamp", F.timestamp_seconds(F.lit(5))))
    publish_control(spark.createDataFrame([("fact", "a"), ("dim", "a")], CONTROL), f"{root}/control")
    common = ("--replay", f"{root}/t", "--control", f"{root}/control", "--once", "--checkpoint")
    run(spark, "change-split", *common, f"{root}/c1", "--out", f"{root}/out", "--dims", f"{root}/dims", "--buckets", "3",
        "--progress", f"{root}/progress", "--counts", f"{root}/counts", "--partitions", "2")
    progress = ProgressListener(spark, f"{root}/progress")
    assert [(r["partition"], r["from_offset"], r["to_offset"]) for r in progress.rows().collect()] == [(0, 5, 7)]
    found = {r["name"]: r["n"] for r in jobs.count_log(spark, f"{root}/counts").rows().filter("n > 0").collect()}
    assert found == {"read": 2, "changes": 1, "routed": 2, "fact": 1, "dim": 1, "malformed": 1}
    assert KeyedTable(spark, f"{root}/dims")._manifest()["buckets"] == 3
    run(spark, "dim-state", *common, f"{root}/c2", "--state-partitions", "2")
    assert [(r["space"], r["id"]) for r in dim_state(spark, f"{root}/c2").collect()] == [("DIM:A", "1")]
    run(spark, "order-merge", "--wide", f"{root}/merged", "--state-partitions", "2", "--salts", "2", *common, f"{root}/c3")
    assert [(r["kind"], r["detail_id"]) for r in merged(spark, f"{root}/merged").collect()] == [("matched", 7)]


@pytest.mark.parametrize("words", [
    ("log-split",), ("log-split", "--replay", "x"), ("change-split", "--servers", "h"),
    ("log-split", "--replay", "x", "--out", "y", "--start", "latest"), ("daily-active", "--replay", "x"),
])
def test_missing_options(spark, words):
    with pytest.raises(SystemExit):
        app.start(spark, app.parser().parse_args([*words, "--checkpoint", "cp"]))
