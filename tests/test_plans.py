"""Physical plans: one decode, no needless shuffle, no unchecked broadcast, no pair-up of groups."""

import re

import pytest
from pyspark.sql import functions as F

from sluice.operators import change_routes as cr
from sluice.operators import log_routes as lr
from sluice.operators.parse import parse_change, parse_log
from sluice.plans import envelopes as env
from sluice.plans.catalog import QUERIES, STREAMING
from sluice.schemas import CONTROL, TOPIC_RECORD
from sluice.session import scratch_dir

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def topic(spark):
    from sluice.plans.envelopes import app_log

    path = scratch_dir(spark, "plans")
    app_log(spark, SF).write.parquet(path)
    return spark.read.schema(TOPIC_RECORD).parquet(path)


@pytest.mark.parametrize(
    "route",
    [lr.log_messages, lr.page_log, lr.page_display_log, lr.page_action_log, lr.start_log,
     lr.error_log, lr.unrouted_log, lr.quarantined_log],
)
def test_log_routes_decode_once_and_never_shuffle(topic, route):
    text = plan(route(parse_log(topic)))
    assert text.count("from_json(") == 1
    assert "Exchange" not in text and "InMemory" not in text.replace("InMemoryFileIndex", "")


def test_typed_route_reads_only_the_text(topic):
    assert "ReadSchema: struct<value:string>" in plan(lr.page_log(parse_log(topic)))


def test_change_split_decodes_once_and_shuffles_once(spark, topic):
    control = spark.sql("SELECT * FROM VALUES ('fact', 'a'), ('dim', 'b') AS c(role, table_name)")
    routed = cr.routed_changes(cr.coded_changes(parse_change(topic)), control)
    facts, dims = plan(cr.change_messages(routed)), plan(cr.latest_dims(cr.dim_rows(routed)))
    assert facts.count("from_json(") == 1 and dims.count("from_json(") == 1
    assert dims.count("Exchange hashpartitioning") == 1 and "hashpartitioning(space" in dims
    assert "Exchange hashpartitioning" not in facts
    # Limited to one row per key and task before the shuffle.
    assert "row_number(), 1, Partial" in dims.split("Exchange hashpartitioning")[1]


def test_every_batch_query_decodes_once(spark):
    """As often as it names its topic, and never in a filter or a scan."""
    for name, query in QUERIES.items():
        if name not in STREAMING:
            lines = [x for x in plan(query(spark, SF)).split("\n") if "from_json(" in x]
            assert not [x for x in lines if "Filter" in x or "FileScan" in x], name


def test_no_query_pairs_up_rows(spark):
    """No cartesian product and no nested-loop join in any batch query."""
    for name, query in QUERIES.items():
        if name not in STREAMING:
            text = plan(query(spark, SF))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name
            assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_control_schema():
    assert CONTROL.names == ["role", "table_name"]


def test_hundredths_round_like_spark(spark):
    near = [0.005, 0.015, 0.025, 1.005, 2.675, 0.125, 0.00499999999999999994, 1234567.885, 9.0e15, 45035996273704.955, 0.0, 17.5]
    rows = [(sign * x,) for x in [*near, *(i / 1000 for i in range(4000)), *(i / 800 for i in range(4000))] for sign in (1.0, -1.0)]
    amounts = spark.createDataFrame([*rows, (None,)], "x double")
    found = amounts.select("x", env._hundredths(F.col("x")).alias("a"), F.round(F.col("x") * 100).cast("bigint").alias("b"))
    assert found.filter("not (a <=> b)").collect() == []
    assert found.schema["a"].dataType == found.schema["b"].dataType


def test_order_details_round_no_decimals_and_shuffle_no_part_names(spark):
    made = env.order_detail(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in made
    # The topmost join comes first.
    assert re.findall(r"Join Inner, \((\w+)#", made) == ["l_partkey", "l_orderkey"]
