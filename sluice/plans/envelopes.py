"""Raw topics derived from the given tables (mapping: ``FIXTURES.md``).

Every builder is row-local apart from key lookups, so it scales with its tables: surrogate ids
are hashes, not a global row number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.change_routes import ChangeTopics
from sluice.operators.log_routes import LogTopics
from sluice.plans.tables import table
from sluice.schemas import CONTROL


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a zone-less UTC timestamp, truncated, whatever the session zone."""
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts)
    return F.unix_millis(utc.cast("timestamp"))


# Partitions of the app-log topic.
LOG_PARTITIONS = 4


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App-log topic: one record per event, with the columns of a topic source."""
    event_id, kind, event_type = F.col("event_id"), F.col("kind"), F.col("event_type")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = (
        events.join(customers, F.col("user_id") == F.col("c_custkey"))
        .withColumn(
            "kind",
            F.when(event_id % 97 == 0, "none")
            .when(event_type == "error", "error")
            .when(event_type == "signup", "start")
            .otherwise("page"),
        )
        .withColumn("ms", epoch_ms(F.col("ts")))
    )
    common = F.struct(
        F.col("c_nationkey").cast("string").alias("ar"),
        F.col("user_id").cast("string").alias("uid"),
        F.when(event_id % 2 == 0, "iOS").otherwise("Android").alias("os"),
        _numbered("ch_", event_id % 5).alias("ch"),
        F.when(event_id % 4 == 0, "1").otherwise("0").alias("is_new"),
        _numbered("md_", event_id % 7).alias("md"),
        _numbered("mid_", F.col("user_id")).alias("mid"),
        _numbered("v2.", event_id % 10).alias("vc"),
        _numbered("ba_", event_id % 3).alias("ba"),
    )
    # Error records also carry a page, to prove that an error suppresses it.
    page = F.when(
        kind.isin("page", "error"),
        F.struct(
            event_type.alias("page_id"),
            (event_id % 100).alias("item"),
            F.lit("sku_id").alias("item_type"),
            (event_id % 1000).alias("during_time"),
            F.when(event_id % 3 != 0, "home").alias("last_page_id"),
            F.lit("promotion").alias("source_type"),
        ),
    )
    # One quoted number and one number where text is expected: both must read as declared.
    start = F.when(
        (kind == "start") | ((kind == "page") & (event_type == "purchase") & (event_id % 10 == 0)),
        F.struct(
            F.lit("icon").alias("entry"),
            (event_id % 100).alias("loading_time"),
            (event_id % 20).alias("open_ad_id"),
            (event_id % 500).cast("string").alias("open_ad_ms"),
            F.lit(0).alias("open_ad_skip_ms"),
        ),
    )
    displays = F.when(
        event_type == "view",
        F.transform(
            _counted(event_id % 4, 3),
            lambda i: F.struct(
                F.lit("query").alias("display_type"),
                i.alias("item"),
                F.lit("sku_id").alias("item_type"),
                (i % 2).alias("pos_id"),
                i.alias("order"),
            ),
        ),
    )
    actions = F.when(
        event_type == "click",
        F.transform(
            _counted(1 + event_id % 2, 2),
            lambda i: F.struct(
                _numbered("a_", i).alias("action_id"),
                i.alias("item"),
                F.lit("sku_id").alias("item_type"),
                (F.col("ms") + i).alias("ts"),
            ),
        ),
    )
    err = F.when(
        kind == "error",
        F.struct((event_id % 1000).alias("error_code"), F.lit("e").alias("msg")),
    )
    value = F.to_json(F.struct(
        common.alias("common"),
        page.alias("page"),
        displays.alias("displays"),
        actions.alias("actions"),
        start.alias("start"),
        err.alias("err"),
        F.col("ms").alias("ts"),
    ))
    return joined.select(
        F.lit(LogTopics.source).alias("topic"),
        (F.col("user_id") % LOG_PARTITIONS).cast("int").alias("partition"),
        event_id.alias("offset"),
        F.timestamp_millis("ms").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
    )


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _counted(n: Column, most: int) -> Column:
    """1..n for n in 0..most."""
    return F.slice(F.sequence(F.lit(1), F.lit(most)), F.lit(1), n.cast("int"))


def damaged_app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The app-log topic with every kind of unusable record in it, spread by event id."""
    n, value = F.col("offset") % 11, F.col("value")
    return app_log(spark, sf_dir).withColumn(
        "value",
        F.when(n == 0, F.substring(value, 1, 20))
        .when(n == 1, F.lit(""))
        .when(n == 2, F.lit(None))
        .when(n == 3, F.lit("[]"))
        .when(n == 4, F.replace(value, F.lit('"common"'), F.lit('"other"')))
        .when(n == 5, F.regexp_replace(value, r'"ts":(\d+)}$', r'"ts":"x$1"}'))
        .when(n == 6, F.lit('{"common":{"mid":"m"},"page":{"page_id":"p"},"displays":[null]}'))
        .when(n == 7, F.lit('{"common":{"mid":"m"},"page":"{}"}'))
        .otherwise(value),
    )


def _per_order(values: list[float], key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % 4 + 1).cast("int"))


def _order_time(orders: DataFrame) -> Column:
    seconds = F.col("o_orderkey") % 86400
    return orders["o_orderdate"] + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders, and the record time ``created``."""
    orders = table(spark, sf_dir, "orders").drop("o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    key = F.col("o_orderkey")
    created = _order_time(orders)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        _per_order([0.0, 1.5, 2.5, 3.5], key).alias("activity_reduce_amount"),
        _per_order([0.0, 5.0, 10.0, 15.0], key).alias("coupon_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        _per_order([0.0, 8.0, 12.0, 20.0], key).alias("feight_fee"),
        _per_order([0.0, 0.0, 4.0, 8.0], key).alias("feight_fee_reduce"),
        created.cast("string").alias("create_time"),
        F.timestamp_millis(epoch_ms(created)).alias("created"),
    )


def _hundredths(amount: Column) -> Column:
    """``round(amount * 100)`` as a bigint, halves away from zero; Spark's own makes a text and a decimal of every value."""
    scaled = amount * 100
    whole = scaled.cast("bigint")
    rest = scaled - whole
    return whole + F.when((rest >= 0.5) & (rest < 1), 1).when((rest <= -0.5) & (rest > -1), -1).otherwise(0)


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order details, and the record time ``created``. The id is a 52-bit hash of the row,
    since the table has no unique key."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    identity = F.concat_ws(
        "|",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("bigint"),
        *[_hundredths(F.col(c)) for c in ("l_extendedprice", "l_discount", "l_tax")],
        "l_returnflag", "l_linestatus",
        F.unix_date(F.col("l_shipdate").cast("date")),
    )
    line_id = F.conv(F.substring(F.md5(identity), 1, 13), 16, 10).cast("bigint")
    rows = (
        lines.withColumn("id", line_id)
        # Where both are merged, the second shuffle carries a date instead of a part's name and price.
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("detail_time", _order_time(orders) + F.expr("interval 1 second"))
    )
    return rows.select(
        "id",
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("p_retailprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("p_name").alias("sku_name"),
        F.when(F.col("id") % 50 != 0, F.col("detail_time").cast("string")).alias("create_time"),
        F.col("l_extendedprice").alias("split_total_amount"),
        F.lit(0.0).alias("split_activity_amount"),
        F.lit(0.0).alias("split_coupon_amount"),
        F.timestamp_millis(epoch_ms(F.col("detail_time"))).alias("created"),
    )


CONTROL_ROWS = [
    ("fact", "order_info"),
    ("fact", "order_detail"),
    ("fact", "supplier_info"),
    ("dim", "supplier_info"),
    ("dim", "user_info"),
    ("dim", "base_province"),
]
# A later record of the same key has a higher step, and every step-1 offset follows all of step 0.
STEP_BITS = 60


def control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONTROL_ROWS, CONTROL)


DIM_TABLES = ("user_info", "base_province")


def change_log(spark: SparkSession, sf_dir: str, only: tuple[str, ...] | None = None) -> DataFrame:
    """Change-log topic over six tables, with control records that carry no row; or over the
    tables in ``only``."""
    builders = {
        "order_info": lambda: [_order_changes(spark, sf_dir)],
        "order_detail": lambda: [_detail_changes(spark, sf_dir)],
        "user_info": lambda: [_user_changes(spark, sf_dir), _markers(spark, sf_dir)],
        "base_province": lambda: [_province_changes(spark, sf_dir)],
        "supplier_info": lambda: [
            _named_changes(table(spark, sf_dir, "supplier"), 4, "supplier_info", "s_suppkey", "s_name")
        ],
        "base_region": lambda: [
            _named_changes(table(spark, sf_dir, "region"), 5, "base_region", "r_regionkey", "r_name")
        ],
    }
    parts = [part for name in only or builders for part in builders[name]()]
    return reduce(DataFrame.unionByName, parts)


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, key = order_info(spark, sf_dir), F.col("id")
    return _changes(rows, 0, "order_info", key, _fact_type(key), payload(rows), created=F.col("created"))


def _detail_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, key = order_detail(spark, sf_dir), F.col("id")
    return _changes(rows, 1, "order_detail", key, _fact_type(key), payload(rows), created=F.col("created"))


def _user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insert per customer, a later update for every third and a last delete for every tenth."""
    key, step = F.col("c_custkey"), F.col("step")
    steps = F.array_compact(F.array(F.lit(0), F.when(key % 3 == 0, 1), F.when(key % 10 == 0, 2)))
    rows = table(spark, sf_dir, "customer").withColumn("step", F.explode(steps))
    data = F.struct(
        key.alias("id"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        (18 + key % 50).alias("age"),
        step.alias("rev"),
    )
    kind = F.when(step == 0, "insert").when(step == 1, "update").otherwise("delete")
    return _changes(rows, 2, "user_info", key, kind, data, step)


def _province_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("n_nationkey"), F.col("n_nationkey").cast("string")
    data = F.struct(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("1000"), name).alias("area_code"),
        F.concat(F.lit("CN-"), name).alias("iso_code"),
        F.concat(F.lit("ISO-"), name).alias("iso_3166_2"),
    )
    return _changes(table(spark, sf_dir, "nation"), 3, "base_province", key, F.lit("insert"), data)


def _named_changes(rows: DataFrame, number: int, name: str, key: str, label: str) -> DataFrame:
    data = F.struct(F.col(key).alias("id"), F.col(label).alias("name"))
    return _changes(rows, number, name, F.col(key), F.lit("insert"), data)


def _markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(t) for t in ("bootstrap-start", "bootstrap-complete", "table-create")])
    rows = table(spark, sf_dir, "region").withColumn("type", F.explode(kinds))
    return _changes(rows, 6, "user_info", F.col("r_regionkey"), F.col("type"), None)


def payload(rows: DataFrame) -> Column:
    return F.struct(*[c for c in rows.columns if c != "created"])


def _fact_type(key: Column) -> Column:
    digit = key % 10
    return (
        F.when(digit <= 5, "insert").when(digit <= 7, "update").when(digit == 8, "delete")
        .otherwise("bootstrap-insert")
    )


def _changes(
    rows: DataFrame, number: int, name: str, key: Column, change: Column, data: Column | None,
    step: Column | None = None, created: Column | None = None,
) -> DataFrame:
    step = F.lit(0) if step is None else step
    fields = [change.alias("type"), F.lit(name).alias("table")]
    if data is not None:
        fields.append(data.alias("data"))
    offset = F.shiftleft(step.cast("bigint"), STEP_BITS) + key.cast("bigint") * 8 + number
    return rows.select(
        F.lit(ChangeTopics.source).alias("topic"),
        (key % 4).cast("int").alias("partition"),
        offset.alias("offset"),
        (F.timestamp_millis(F.lit(1704067200000)) if created is None else created).alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )
