"""Input envelopes and output contracts as Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
}


def struct(*specs: tuple[str, str]) -> T.StructType:
    """``struct(("string", "a b"), ("bigint", "c"))``: fields in order, grouped by type."""
    return T.StructType(
        [T.StructField(name, _TYPES[kind]) for kind, names in specs for name in names.split()]
    )


def strings(names: str) -> T.StructType:
    return struct(("string", names))


CORRUPT = "_corrupt_record"

# Rows of a topic, with the column names of Spark's Kafka source.
TOPIC_RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# Input envelopes. Numbers are read as text and cast later, because a quoted number read as
# bigint turns into NULL. `err` and `data` keep the raw JSON of whatever stands there.
APP_LOG = T.StructType([
    T.StructField("common", strings("ar uid os ch is_new md mid vc ba")),
    T.StructField("page", strings("page_id item item_type during_time last_page_id source_type")),
    T.StructField("displays", T.ArrayType(strings("display_type item item_type pos_id order"))),
    T.StructField("actions", T.ArrayType(strings("action_id item item_type ts"))),
    T.StructField("start", strings("entry loading_time open_ad_id open_ad_ms open_ad_skip_ms")),
    T.StructField("err", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField(CORRUPT, T.StringType()),
])

CHANGE = strings(f"type table data {CORRUPT}")

CONTROL = strings("role table_name")

# Field names and types of the typed outputs.
_COMMON = "mid user_id province_id channel is_new model operate_system version_code brand"
_PAGE = (
    ("string", f"{_COMMON} page_id last_page_id page_item page_item_type"),
    ("bigint", "during_time"),
    ("string", "sourceType"),
)

PAGE_LOG = struct(*_PAGE, ("bigint", "ts"))

PAGE_DISPLAY_LOG = struct(
    *_PAGE,
    ("string", "display_type display_item display_item_type display_order display_pos_id"),
    ("bigint", "ts"),
)

PAGE_ACTION_LOG = struct(
    *_PAGE,
    ("string", "action_id action_item action_item_type"),
    ("bigint", "action_ts ts"),
)

START_LOG = struct(
    ("string", f"{_COMMON} entry open_ad_id"),
    ("bigint", "loading_time_ms open_ad_ms open_ad_skip_ms ts"),
)

DAU_INFO = struct(
    ("string", f"{_COMMON} page_id page_item page_item_type sourceType"),
    ("bigint", "during_time"),
    ("string", "user_gender user_age"),
    ("string", "province_name province_iso_code province_3166_2 province_area_code"),
    ("string", "dt hr"),
    ("bigint", "ts"),
)

ORDER_INFO = struct(
    ("bigint", "id province_id"),
    ("string", "order_status"),
    ("bigint", "user_id"),
    ("double", "total_amount activity_reduce_amount coupon_reduce_amount"),
    ("double", "original_total_amount feight_fee feight_fee_reduce"),
    ("string", "expire_time refundable_time create_time operate_time create_date create_hour"),
    ("string", "province_name province_area_code province_3166_2_code province_iso_code"),
    ("int", "user_age"),
    ("string", "user_gender"),
)

ORDER_DETAIL = struct(
    ("bigint", "id order_id sku_id"),
    ("double", "order_price"),
    ("bigint", "sku_num"),
    ("string", "sku_name create_time"),
    ("double", "split_total_amount split_activity_amount split_coupon_amount"),
)

ORDER_WIDE = struct(
    ("bigint", "detail_id order_id sku_id"),
    ("double", "order_price"),
    ("bigint", "sku_num"),
    ("string", "sku_name"),
    ("double", "split_total_amount split_activity_amount split_coupon_amount"),
    ("bigint", "province_id"),
    ("string", "order_status"),
    ("bigint", "user_id"),
    ("double", "total_amount activity_reduce_amount coupon_reduce_amount"),
    ("double", "original_total_amount feight_fee feight_fee_reduce"),
    ("string", "expire_time refundable_time create_time operate_time create_date create_hour"),
    ("string", "province_name province_area_code province_3166_2_code province_iso_code"),
    ("int", "user_age"),
    ("string", "user_gender"),
)

USER_DIM = strings("id gender age")
PROVINCE_DIM = strings("id name area_code iso_code iso_3166_2")
