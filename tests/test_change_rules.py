"""Change-stream rules."""

import json

import pytest

from sluice.operators import change_routes as cr
from sluice.operators.parse import parse_change
from sluice.schemas import CONTROL

RULES = [("fact", "order_info"), ("fact", "both"), ("dim", "both"), ("dim", "user_info")]


def change(kind, table, data=None):
    return json.dumps({"type": kind, "table": table, "data": data, "xid": 5})


@pytest.fixture
def route(spark, records):
    control = spark.createDataFrame(RULES, CONTROL)

    def run(values, **how):
        return cr.routed_changes(cr.coded_changes(parse_change(records(values))), control, **how)

    return run


@pytest.mark.parametrize(
    "kind, op",
    [("insert", "I"), ("update", "U"), ("delete", "D"), ("bootstrap-insert", "I"),
     ("INSERT", None), ("bootstrap-start", None), ("table-create", None), (None, None)],
)
def test_op_code(records, kind, op):
    rows = cr.coded_changes(parse_change(records([change(kind, "t", {"id": 1})]))).collect()
    assert [r["op"] for r in rows] == ([op] if op else [])


def test_routes(route):
    routed = route([
        change("insert", "order_info", {"id": 1}),
        change("delete", "both", {"id": 2}),
        change("update", "user_info", {"id": "u3"}),
        change("insert", "other", {"id": 4}),
        change("insert", "Order_Info", {"id": 5}),
    ])
    facts = {(r["topic"], r["data"]) for r in cr.fact_rows(routed).collect()}
    assert facts == {
        ("DWD_ORDER_INFO_I_1018", '{"id":1}'), ("DWD_BOTH_D_1018", '{"id":2}'),
    }
    dims = {(r["space"], r["id"], r["op"]) for r in cr.dim_rows(routed).collect()}
    assert dims == {("DIM:BOTH", "2", "D"), ("DIM:USER_INFO", "u3", "U")}


def test_quarantine(route):
    routed = route([
        "nope", "", None,
        change("insert", "order_info"),
        change("insert", "user_info"),
        change("insert", "user_info", {"name": "x"}),
        change("insert", "both", {"name": "x"}),
        change("insert", "other"),
        change("bootstrap-start", "user_info"),
    ])
    reasons = sorted((r["offset"], r["reason"]) for r in routed.collect())
    assert reasons == [
        (0, "malformed"), (1, "malformed"), (2, "malformed"), (3, "no_data"), (4, "no_data"),
        (5, "no_id"), (6, "no_id"),
    ]
    sent = cr.change_messages(routed).collect()
    assert {r["topic"] for r in sent} == {"QUARANTINE_DB_1018"} and len(sent) == 7
    assert json.loads(sent[0]["value"])["reason"] == "malformed"
    with pytest.raises(Exception, match="cannot route record"):
        cr.change_messages(routed, on_malformed="fail").collect()


def test_data_keeps_null_keys_and_nesting(route):
    routed = route(['{"type":"insert","table":"order_info","data":{"id":1,"a":null,"b":{"c":[1]}}}'])
    (row,) = cr.fact_rows(routed).collect()
    assert json.loads(row["data"]) == {"id": 1, "a": None, "b": {"c": [1]}}


def test_keyed_messages(route):
    routed = route([change("insert", "order_info", {"id": 31})])
    assert [r["key"] for r in cr.change_messages(routed).collect()] == [None]
    assert [r["key"] for r in cr.change_messages(routed, key_by_id=True).collect()] == ["31"]


def test_large_control_set_takes_the_salted_join(route):
    values = [change("insert", t, {"id": i}) for i, t in enumerate(["order_info", "both", "user_info", "x"] * 50)]
    values += ["nope"] * 5
    small, large = route(values), route(values, broadcast_rows=1)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)
    assert large.count() == 155


def test_last_writer_wins_within_a_batch(route):
    routed = route([
        change("insert", "user_info", {"id": 1, "v": 1}),
        change("update", "user_info", {"id": 1, "v": 2}),
        change("delete", "user_info", {"id": 1, "v": 3}),
        change("insert", "user_info", {"id": 2, "v": 1}),
    ])
    latest = {r["id"]: (r["op"], json.loads(r["data"])["v"]) for r in cr.latest_dims(cr.dim_rows(routed)).collect()}
    assert latest == {"1": ("D", 3), "2": ("I", 1)}
    shuffled = cr.latest_dims(cr.dim_rows(routed).repartition(7))
    assert {r["id"]: r["op"] for r in shuffled.collect()} == {"1": "D", "2": "I"}
