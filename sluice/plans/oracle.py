"""DuckDB SQL for the registered queries.

Expected rows are computed straight from the tables and never pass through a JSON parser, so both
paths are independent; message texts are put together field by field.
"""

from __future__ import annotations

# Common table expressions, each usable after the ones it names.

EVENTS = """
e AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ts,
         CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
         CAST(c_nationkey AS VARCHAR) AS province_id,
         CASE WHEN event_id % 97 = 0 THEN 'none'
              WHEN event_type = 'error' THEN 'error'
              WHEN event_type = 'signup' THEN 'start'
              ELSE 'page' END AS kind,
         'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid,
         'ch_' || event_id % 5 AS channel,
         CASE WHEN event_id % 4 = 0 THEN '1' ELSE '0' END AS is_new,
         'md_' || event_id % 7 AS model,
         CASE WHEN event_id % 2 = 0 THEN 'iOS' ELSE 'Android' END AS operate_system,
         'v2.' || event_id % 10 AS version_code, 'ba_' || event_id % 3 AS brand
  FROM events JOIN customer ON user_id = c_custkey
),
f AS (
  SELECT e.*, event_type AS page_id,
         CASE WHEN event_id % 3 <> 0 THEN 'home' END AS last_page_id,
         CAST(event_id % 100 AS VARCHAR) AS page_item, 'sku_id' AS page_item_type,
         event_id % 1000 AS during_time, 'promotion' AS sourceType,
         kind IN ('page', 'error') AS has_page,
         kind = 'start' OR (kind = 'page' AND event_type = 'purchase' AND event_id % 10 = 0)
           AS has_start
  FROM e
),
page AS (SELECT * FROM f WHERE kind = 'page'),
display AS (
  SELECT page.*, 'query' AS display_type, CAST(i AS VARCHAR) AS display_item,
         'sku_id' AS display_item_type, CAST(i AS VARCHAR) AS display_order,
         CAST(i % 2 AS VARCHAR) AS display_pos_id
  FROM page, (VALUES (1), (2), (3)) g(i) WHERE event_type = 'view' AND i <= event_id % 4
),
action AS (
  SELECT page.*, 'a_' || i AS action_id, CAST(i AS VARCHAR) AS action_item,
         'sku_id' AS action_item_type, ts + i AS action_ts
  FROM page, (VALUES (1), (2)) g(i) WHERE event_type = 'click' AND i <= 1 + event_id % 2
),
start_log AS (
  SELECT f.*, 'icon' AS entry, CAST(event_id % 20 AS VARCHAR) AS open_ad_id,
         event_id % 100 AS loading_time_ms, event_id % 500 AS open_ad_ms,
         CAST(0 AS BIGINT) AS open_ad_skip_ms
  FROM f WHERE kind <> 'error' AND has_start
)"""

COMMON = [
    ("mid", "mid"), ("user_id", "uid"), ("province_id", "province_id"), ("channel", "channel"),
    ("is_new", "is_new"), ("model", "model"), ("operate_system", "operate_system"),
    ("version_code", "version_code"), ("brand", "brand"),
]
PAGE = [
    *COMMON, ("page_id", "page_id"), ("last_page_id", "last_page_id"), ("page_item", "page_item"),
    ("page_item_type", "page_item_type"), ("during_time", "during_time"), ("sourceType", "sourceType"),
]
TS = [("ts", "ts")]
DISPLAY = PAGE + [(n, n) for n in (
    "display_type", "display_item", "display_item_type", "display_order", "display_pos_id"
)] + TS
ACTION = PAGE + [(n, n) for n in ("action_id", "action_item", "action_item_type", "action_ts")] + TS
START = COMMON + [(n, n) for n in (
    "entry", "open_ad_id", "loading_time_ms", "open_ad_ms", "open_ad_skip_ms"
)] + TS
NUMBERS = {"during_time", "ts", "action_ts", "loading_time_ms", "open_ad_ms", "open_ad_skip_ms"}


def columns(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for name, expr in fields)


def obj(fields: list[tuple[str, str]], bare: set[str] | None = None) -> str:
    """SQL for a JSON object text: NULL fields left out, fields in ``bare`` unquoted."""
    bare = NUMBERS if bare is None else bare
    parts = []
    for name, expr in fields:
        text = f"({expr})" if name in bare else f"'\"' || ({expr}) || '\"'"
        parts.append(f"'\"{name}\":' || {text}")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def listed(counts: str, most: int, item) -> str:
    """SQL for a JSON array text of the first ``counts`` items."""
    items = ", ".join(f"CASE WHEN {counts} >= {i} THEN {item(i)} END" for i in range(1, most + 1))
    return f"'[' || concat_ws(',', {items}) || ']'"


RAW_COMMON = obj([
    ("ar", "province_id"), ("uid", "uid"), ("os", "operate_system"), ("ch", "channel"),
    ("is_new", "is_new"), ("md", "model"), ("mid", "mid"), ("vc", "version_code"), ("ba", "brand"),
])
RAW_PAGE = obj([
    ("page_id", "page_id"), ("item", "page_item"), ("item_type", "page_item_type"),
    ("during_time", "during_time"), ("last_page_id", "last_page_id"), ("source_type", "sourceType"),
], {"item", "during_time"})
RAW_DISPLAYS = listed("event_id % 4", 3, lambda i: obj([
    ("display_type", "'query'"), ("item", str(i)), ("item_type", "'sku_id'"),
    ("pos_id", str(i % 2)), ("order", str(i)),
], {"item", "pos_id", "order"}))
RAW_ACTIONS = listed("1 + event_id % 2", 2, lambda i: obj([
    ("action_id", f"'a_{i}'"), ("item", str(i)), ("item_type", "'sku_id'"), ("ts", f"ts + {i}"),
], {"item", "ts"}))
RAW_START = obj([
    ("entry", "'icon'"), ("loading_time", "event_id % 100"), ("open_ad_id", "event_id % 20"),
    ("open_ad_ms", "event_id % 500"), ("open_ad_skip_ms", "0"),
], {"loading_time", "open_ad_id", "open_ad_skip_ms"})
RAW_ERR = obj([("error_code", "event_id % 1000"), ("msg", "'e'")], {"error_code"})
RAW_FIELDS = [
    ("common", RAW_COMMON),
    ("page", f"CASE WHEN has_page THEN {RAW_PAGE} END"),
    ("displays", f"CASE WHEN event_type = 'view' THEN {RAW_DISPLAYS} END"),
    ("actions", f"CASE WHEN event_type = 'click' THEN {RAW_ACTIONS} END"),
    ("start", f"CASE WHEN has_start THEN {RAW_START} END"),
    ("err", f"CASE WHEN kind = 'error' THEN {RAW_ERR} END"),
    ("ts", "ts"),
]
RAW = obj(RAW_FIELDS, {name for name, _ in RAW_FIELDS})

LOG_MESSAGES = f"""
m AS (
  SELECT 'DWD_PAGE_LOG_TOPIC_1018' AS topic, {obj(PAGE + TS)} AS value, event_id FROM page
  UNION ALL SELECT 'DWD_PAGE_DISPLAY_TOPIC_1018', {obj(DISPLAY)}, event_id FROM display
  UNION ALL SELECT 'DWD_PAGE_ACTION_TOPIC_1018', {obj(ACTION)}, event_id FROM action
  UNION ALL SELECT 'DWD_START_LOG_TOPIC_1018', {obj(START)}, event_id FROM start_log
  UNION ALL SELECT 'DWD_ERROR_LOG_TOPIC_1018', {RAW}, event_id FROM f WHERE kind = 'error'
),
cut AS (SELECT (max(event_id) + 1) // 2 AS middle FROM events)"""

ORDERS = """
o AS (
  SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id,
         o_orderstatus AS order_status, o_custkey AS user_id, o_totalprice AS total_amount,
         CAST(CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1.5 WHEN 2 THEN 2.5 ELSE 3.5 END AS DOUBLE)
           AS activity_reduce_amount,
         CAST(CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 10 ELSE 15 END AS DOUBLE)
           AS coupon_reduce_amount,
         o_totalprice AS original_total_amount,
         CAST(CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 8 WHEN 2 THEN 12 ELSE 20 END AS DOUBLE)
           AS feight_fee,
         CAST(CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 4 ELSE 8 END AS DOUBLE)
           AS feight_fee_reduce,
         CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS refundable_time,
         strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS create_time,
         CAST(NULL AS VARCHAR) AS operate_time,
         strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d') AS create_date,
         strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H') AS create_hour
  FROM orders JOIN customer ON o_custkey = c_custkey
),
l AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
           CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT),
           l_returnflag, l_linestatus, epoch_us(l_shipdate) // 86400000000)), 1, 13) AS BIGINT) AS id
  FROM lineitem
),
d AS (
  SELECT l.id, l_orderkey AS order_id, l_partkey AS sku_id, p_retailprice AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num, p_name AS sku_name,
         CASE WHEN l.id % 50 <> 0 THEN strftime(
           o_orderdate + to_seconds(o_orderkey % 86400 + 1), '%Y-%m-%d %H:%M:%S') END AS create_time,
         l_extendedprice AS split_total_amount,
         CAST(0 AS DOUBLE) AS split_activity_amount, CAST(0 AS DOUBLE) AS split_coupon_amount
  FROM l JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
)"""

ORDER_FIELDS = [
    "id", "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "feight_fee_reduce", "create_time",
]
DETAIL_FIELDS = [
    "id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "create_time",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
]
ORDER_JSON = obj([(n, n) for n in ORDER_FIELDS], set(ORDER_FIELDS) - {"order_status", "create_time"})
DETAIL_JSON = obj([(n, n) for n in DETAIL_FIELDS], set(DETAIL_FIELDS) - {"sku_name", "create_time"})


def fact_type(key: str) -> str:
    return (
        f"CASE WHEN {key} % 10 <= 5 THEN 'insert' WHEN {key} % 10 <= 7 THEN 'update' "
        f"WHEN {key} % 10 = 8 THEN 'delete' ELSE 'bootstrap-insert' END"
    )


CHANGES = f"""
c AS (
  SELECT 'order_info' AS table_name, {fact_type('id')} AS type, id AS key, 0 AS step, 0 AS number,
         {ORDER_JSON} AS data FROM o
  UNION ALL SELECT 'order_detail', {fact_type('id')}, id, 0, 1, {DETAIL_JSON} FROM d
  UNION ALL SELECT 'user_info', CASE step WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END,
         c_custkey, step, 2,
         '{{"id":' || c_custkey || ',"gender":"' || CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END
         || '","age":' || 18 + c_custkey % 50 || ',"rev":' || step || '}}'
    FROM customer, (VALUES (0), (1), (2)) s(step)
    WHERE step = 0 OR (step = 1 AND c_custkey % 3 = 0) OR (step = 2 AND c_custkey % 10 = 0)
  UNION ALL SELECT 'base_province', 'insert', n_nationkey, 0, 3,
         '{{"id":' || n_nationkey || ',"name":"' || n_name || '","area_code":"1000' || n_nationkey
         || '","iso_code":"CN-' || n_nationkey || '","iso_3166_2":"ISO-' || n_nationkey || '"}}'
    FROM nation
  UNION ALL SELECT 'supplier_info', 'insert', s_suppkey, 0, 4,
         '{{"id":' || s_suppkey || ',"name":"' || s_name || '"}}' FROM supplier
  UNION ALL SELECT 'base_region', 'insert', r_regionkey, 0, 5,
         '{{"id":' || r_regionkey || ',"name":"' || r_name || '"}}' FROM region
  UNION ALL SELECT 'user_info', marker, r_regionkey, 0, 6, NULL
    FROM region, (VALUES ('bootstrap-start'), ('bootstrap-complete'), ('table-create')) t(marker)
),
k AS (
  SELECT *, CAST(key % 4 AS INTEGER) AS "partition",
         CAST(step * 1152921504606846976 + CAST(key AS BIGINT) * 8 + number AS BIGINT) AS "offset",
         CASE type WHEN 'insert' THEN 'I' WHEN 'bootstrap-insert' THEN 'I'
                   WHEN 'update' THEN 'U' WHEN 'delete' THEN 'D' END AS op,
         table_name IN ('order_info', 'order_detail', 'supplier_info') AS is_fact,
         table_name IN ('supplier_info', 'user_info', 'base_province') AS is_dim
  FROM c
),
fact AS (
  SELECT *, 'DWD_' || upper(table_name) || '_' || op || '_1018' AS topic
  FROM k WHERE op IS NOT NULL AND is_fact
),
dim AS (
  SELECT *, 'DIM:' || upper(table_name) || ':' || key AS dim_key
  FROM k WHERE op IS NOT NULL AND is_dim
),
last_dim AS (
  SELECT * FROM dim QUALIFY row_number() OVER (PARTITION BY dim_key ORDER BY step DESC) = 1
)"""

# Looked-up columns by rule: user attributes from the key, province codes from the nation.
PROVINCE = """
p AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS p_id, n_name AS province_name,
         '1000' || n_nationkey AS province_area_code, 'CN-' || n_nationkey AS province_iso_code,
         'ISO-' || n_nationkey AS province_3166_2
  FROM nation
),
u AS (
  SELECT CAST(c_custkey AS VARCHAR) AS u_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender,
         18 + c_custkey % 50 AS user_age
  FROM customer
)"""

ENRICHED = """
oe AS (
  SELECT o.*, province_name, province_area_code, province_3166_2 AS province_3166_2_code,
         province_iso_code, CAST(coalesce(user_age, 0) AS INTEGER) AS user_age, user_gender
  FROM o LEFT JOIN p ON CAST(o.province_id AS VARCHAR) = p_id
         LEFT JOIN u ON CAST(o.user_id AS VARCHAR) = u_id
)"""
PLAIN = """
oe AS (
  SELECT o.*, CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS province_area_code,
         CAST(NULL AS VARCHAR) AS province_3166_2_code, CAST(NULL AS VARCHAR) AS province_iso_code,
         CAST(0 AS INTEGER) AS user_age, CAST(NULL AS VARCHAR) AS user_gender
  FROM o
)"""

_ORDER_TAIL = [
    "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "feight_fee_reduce",
    "expire_time", "refundable_time", "operate_time", "create_date", "create_hour",
    "province_name", "province_area_code", "province_3166_2_code", "province_iso_code",
    "user_age", "user_gender",
]
_DETAIL_NUMBERS = {
    "sku_id": "BIGINT", "order_price": "DOUBLE", "sku_num": "BIGINT", "split_total_amount": "DOUBLE",
    "split_activity_amount": "DOUBLE", "split_coupon_amount": "DOUBLE",
}


def wide(join: str) -> str:
    """Every detail has an order, so defaults are only ever needed on the detail side."""
    detail = ", ".join(
        f"CAST(CASE WHEN d.id IS NULL THEN 0 ELSE d.{n} END AS {t}) AS {n}"
        for n, t in _DETAIL_NUMBERS.items()
    )
    return f"""
SELECT coalesce(d.id, 0) AS detail_id, oe.id AS order_id, {detail}, d.sku_name,
       CASE WHEN d.id IS NOT NULL THEN d.create_time ELSE oe.create_time END AS create_time,
       {", ".join("oe." + n for n in _ORDER_TAIL)}
FROM oe {join} JOIN d ON oe.id = d.order_id"""


_DAU_PAGE = columns([f for f in PAGE if f[0] != "last_page_id"])
_DAU_NONE = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {n}" for n in (
        "user_gender", "user_age", "province_name", "province_iso_code", "province_3166_2",
        "province_area_code",
    )
)
FIRST_VISIT = """
v AS (
  SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS dt,
         strftime(make_timestamp(ts * 1000), '%H') AS hr
  FROM page
  QUALIFY row_number() OVER (
    PARTITION BY mid, ts // 86400000 ORDER BY ts, "partition", "offset") = 1
)"""
FIRST_VISIT_ROWS = f"SELECT {_DAU_PAGE}, {_DAU_NONE}, dt, hr, ts FROM v"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


_LOG = _with(EVENTS)
_MSG = _with(EVENTS, LOG_MESSAGES)
_CHG = _with(ORDERS, CHANGES)
_DAMAGE = """
SELECT "partition", "offset",
       CASE n WHEN 4 THEN 'no_common' WHEN 5 THEN 'bad_number' WHEN 6 THEN 'null_element'
              ELSE 'malformed' END AS reason
FROM (SELECT *, event_id % 11 AS n FROM e)
WHERE n IN (0, 1, 2, 3, 6, 7) OR (n = 4 AND kind <> 'error') OR (n = 5 AND kind <> 'error')"""

_HELD = """
SELECT 'fact' AS kind, topic AS name, data AS value FROM fact {facts}
UNION ALL SELECT 'dim', dim_key, data FROM last_dim {dims}"""

ORACLE = {
    "parse_log": _LOG + f"""
SELECT "partition", "offset",
       CASE WHEN kind = 'error' THEN 'error' WHEN has_page OR has_start THEN 'routed'
            ELSE 'unrouted' END AS verdict,
       mid, CASE WHEN has_page THEN page_id END AS page_id,
       CAST(CASE WHEN event_type = 'view' THEN event_id % 4 END AS INTEGER) AS n_displays,
       CAST(CASE WHEN event_type = 'click' THEN 1 + event_id % 2 END AS INTEGER) AS n_actions,
       CASE WHEN has_start THEN event_id % 500 END AS open_ad_ms,
       CASE WHEN kind = 'error' THEN {RAW_ERR} END AS err, ts
FROM f""",
    "log_page": _LOG + f"SELECT {columns(PAGE + TS)} FROM page",
    "log_display": _LOG + f"SELECT {columns(DISPLAY)} FROM display",
    "log_action": _LOG + f"SELECT {columns(ACTION)} FROM action",
    "log_start": _LOG + f"SELECT {columns(START)} FROM start_log",
    "log_error": _LOG + f"""SELECT "partition", "offset", {RAW} AS value FROM f WHERE kind = 'error'""",
    "log_unrouted": _LOG + f"""
SELECT "partition", "offset", {RAW} AS value FROM f WHERE kind = 'none'""",
    "log_quarantine": _LOG + _DAMAGE,
    "log_page_json": _LOG + f"SELECT {obj(PAGE + TS)} AS value FROM page",
    "log_fanout": _MSG + "SELECT topic, CAST(NULL AS VARCHAR) AS key, value FROM m",
    "parse_cdc": _CHG + 'SELECT "partition", "offset", type, table_name, data FROM k',
    "cdc_op_code": _CHG + """
SELECT "partition", "offset", table_name, type, op FROM k WHERE op IS NOT NULL""",
    "cdc_fact": _CHG + "SELECT topic, table_name, op, data FROM fact",
    "cdc_fact_topics": _CHG + "SELECT topic, count(*) AS n FROM fact GROUP BY topic",
    "cdc_dim": _CHG + """
SELECT dim_key, op, data, "partition" AS src_partition, "offset" AS src_offset FROM dim""",
    "cdc_dim_latest": _CHG + "SELECT dim_key, op, data FROM last_dim",
    "cdc_fanout": _CHG + "SELECT topic, CAST(NULL AS VARCHAR) AS key, data AS value FROM fact",
    "align_columns": _with(ORDERS, PLAIN) + f"""
SELECT CAST(0 AS BIGINT) AS detail_id, id AS order_id, CAST(0 AS BIGINT) AS sku_id,
       CAST(0 AS DOUBLE) AS order_price, CAST(0 AS BIGINT) AS sku_num, CAST(NULL AS VARCHAR) AS sku_name,
       CAST(0 AS DOUBLE) AS split_total_amount, CAST(0 AS DOUBLE) AS split_activity_amount,
       CAST(0 AS DOUBLE) AS split_coupon_amount, create_time, {", ".join(_ORDER_TAIL)}
FROM oe""",
    "page_to_dau": _LOG + f"""
SELECT {_DAU_PAGE}, {_DAU_NONE}, CAST(NULL AS VARCHAR) AS dt, CAST(NULL AS VARCHAR) AS hr, ts
FROM page""",
    "order_date_hour": _with(ORDERS) + "SELECT id, create_time, create_date, create_hour FROM o",
    "order_enrich": _with(ORDERS, PROVINCE, ENRICHED) + f"""
SELECT id, create_time, {", ".join(_ORDER_TAIL)} FROM oe""",
    "order_wide_inner": _with(ORDERS, PLAIN) + wide("INNER"),
    "order_wide_full": _with(ORDERS, PLAIN) + wide("LEFT"),
    "order_wide_enriched": _with(ORDERS, PROVINCE, ENRICHED) + wide("INNER"),
    "dau_first_visit": _with(EVENTS, FIRST_VISIT) + FIRST_VISIT_ROWS,
    "dau_enrich": _with(EVENTS, FIRST_VISIT, PROVINCE) + f"""
SELECT {columns([(n, "v." + e) for n, e in PAGE if n != "last_page_id"])},
       user_gender, CAST(user_age AS VARCHAR) AS user_age, province_name, province_iso_code,
       province_3166_2, province_area_code, dt, hr, ts
FROM v LEFT JOIN p ON province_id = p_id LEFT JOIN u ON uid = u_id""",
    "source_topic": _LOG + f"""
SELECT 'ODS_BASE_LOG_1018' AS topic, "partition", "offset", {RAW} AS value FROM f""",
    "source_from_offsets": _MSG + """
SELECT CAST(CASE WHEN event_id < middle THEN 1 ELSE 2 END AS INTEGER) AS job, topic, value FROM m, cut""",
    "resume_from_checkpoint": _MSG + """
SELECT topic, value, CAST(CASE WHEN event_id < middle THEN 0 ELSE 1 END AS BIGINT) AS batch_id
FROM m, cut""",
    "log_split_stream": _MSG + "SELECT topic, CAST(NULL AS VARCHAR) AS key, value FROM m",
    "offset_progress": """
SELECT 'ODS_BASE_LOG_1018' AS topic, 'ODS_BASE_LOG_GROUP_1018' AS group_id,
       CAST(user_id % 4 AS INTEGER) AS "partition", max(event_id) + 1 AS next_offset
FROM events GROUP BY user_id % 4""",
    "stream_progress": """
WITH h AS (
  SELECT CAST(event_id >= (SELECT (max(event_id) + 1) // 2 FROM events) AS BIGINT) AS batch,
         CAST(user_id % 4 AS INTEGER) AS "partition", min(event_id) AS first, max(event_id) + 1 AS to_offset, count(*) AS "rows"
  FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2
)
SELECT batch, 'ODS_BASE_LOG_1018' AS topic, "partition",
       coalesce(lag(to_offset) OVER (PARTITION BY "partition" ORDER BY batch), first) AS from_offset, to_offset, "rows",
       CAST(0 AS BIGINT) AS late_rows
FROM h""",
    "log_counts_stream": _MSG.rstrip() + f""",
damage AS ({_DAMAGE}),
judged AS (
  SELECT f.event_id, coalesce(reason, CASE WHEN kind = 'error' THEN 'error' WHEN has_page OR has_start THEN 'routed'
                                           ELSE 'unrouted' END) AS verdict
  FROM f LEFT JOIN damage USING ("partition", "offset")
),
told AS (
  SELECT event_id, 'judged' AS step, 'read' AS name FROM judged
  UNION ALL SELECT event_id, 'judged', verdict FROM judged
  UNION ALL SELECT event_id, 'sent', 'QUARANTINE_LOG_1018' FROM judged WHERE verdict NOT IN ('error', 'routed', 'unrouted')
  UNION ALL SELECT event_id, 'sent', topic FROM m JOIN judged USING (event_id) WHERE verdict IN ('error', 'routed')
)
SELECT CAST(event_id >= middle AS BIGINT) AS batch, step, name, count(*) AS n FROM told, cut GROUP BY 1, 2, 3""",
    "cdc_counts_stream": _CHG.rstrip() + """,
told AS (
  SELECT "partition", 'read' AS step, 'read' AS name FROM k
  UNION ALL SELECT "partition", 'coded', 'changes' FROM k WHERE op IS NOT NULL
  UNION ALL SELECT "partition", 'judged', 'routed' FROM k WHERE op IS NOT NULL AND (is_fact OR is_dim)
  UNION ALL SELECT "partition", 'judged', 'fact' FROM fact
  UNION ALL SELECT "partition", 'judged', 'dim' FROM dim
)
SELECT CAST("partition" >= 2 AS BIGINT) AS batch, step, name, count(*) AS n FROM told GROUP BY 1, 2, 3""",
    "dim_state_stream": _CHG + "SELECT dim_key, op, data FROM last_dim",
    "order_merge_stream": _with(ORDERS).rstrip() + """,
t AS (SELECT o_orderkey AS id, epoch_ms(o_orderdate + to_seconds(o_orderkey % 86400)) AS ms FROM orders JOIN customer ON o_custkey = c_custkey),
late AS (SELECT t.id FROM t, (SELECT min(ms) + max(ms) AS twice FROM t) WHERE 2 * ms <= twice AND t.id % 41 = 0),
late_detail AS (
  SELECT d.* FROM d JOIN (SELECT o_orderkey AS id, epoch_ms(o_orderdate + to_seconds(o_orderkey % 86400 + 1)) AS ms FROM orders) x ON x.id = order_id,
       (SELECT min(ms) + max(ms) AS twice FROM t)
  WHERE 2 * ms <= twice AND order_id % 41 = 0
),
oo AS (SELECT * FROM o WHERE id % 43 <> 0 AND id NOT IN (SELECT id FROM late)),
dd AS (SELECT * FROM d ANTI JOIN late_detail USING (id))
SELECT CASE WHEN oo.id IS NULL THEN 'detail_alone' WHEN dd.id IS NULL THEN 'order_alone' ELSE 'matched' END AS kind,
       coalesce(oo.id, dd.order_id) AS order_id, coalesce(dd.id, 0) AS detail_id, order_status,
       coalesce(total_amount, 0) AS total_amount, CASE WHEN dd.id IS NULL THEN 0 ELSE split_total_amount END AS split_total_amount, sku_name,
       CASE WHEN dd.id IS NULL THEN oo.create_time ELSE dd.create_time END AS create_time
FROM oo FULL JOIN dd ON oo.id = dd.order_id
UNION ALL SELECT 'late_order', id, 0, NULL, NULL, NULL, NULL, NULL FROM late WHERE id % 43 <> 0
UNION ALL SELECT 'late_detail', order_id, id, NULL, NULL, NULL, NULL, NULL FROM late_detail""",
    "sink_keyed": _CHG + "SELECT topic, CAST(key AS VARCHAR) AS key, data AS value FROM fact",
    "cdc_split_stream": _CHG + _HELD.format(facts="", dims=""),
    "control_refresh": _CHG + _HELD.format(
        facts="""WHERE table_name = 'order_info' OR "partition" >= 2""",
        dims="""WHERE table_name = 'user_info' OR "partition" >= 2""",
    ),
    "order_wide_stream": _with(ORDERS, PLAIN) + wide("INNER"),
    "dau_stream": _with(EVENTS, FIRST_VISIT) + FIRST_VISIT_ROWS,
}
# The streams must hold what the batch queries give.
ORACLE["order_enrich_stream"] = ORACLE["order_enrich"]
ORACLE["dau_enrich_stream"] = ORACLE["dau_enrich"]
