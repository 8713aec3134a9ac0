"""App-log split: error, page, display, action and start routes over one decoded batch.

Each record is expanded into the outputs it gives ("slots") by one outer explode, so a fan-out
costs one scan, one decode and no shuffle, however many routes are taken. The explode is outer
because Catalyst infers filters below an inner one, which would decode the text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.scalars import message_json, whole
from sluice.operators.parse import ERROR, GOOD, ROUTED, UNROUTED
from sluice.schemas import APP_LOG

PAGE, DISPLAY, ACTION, START, QUARANTINE = "page", "display", "action", "start", "quarantine"
ROUTES = (ERROR, PAGE, DISPLAY, ACTION, START, QUARANTINE)


@dataclass(frozen=True)
class LogTopics:
    # Default topic names.
    source: str = "ODS_BASE_LOG_1018"
    page: str = "DWD_PAGE_LOG_TOPIC_1018"
    display: str = "DWD_PAGE_DISPLAY_TOPIC_1018"
    action: str = "DWD_PAGE_ACTION_TOPIC_1018"
    start: str = "DWD_START_LOG_TOPIC_1018"
    error: str = "DWD_ERROR_LOG_TOPIC_1018"
    # Ours: records that cannot be routed.
    quarantine: str = "QUARANTINE_LOG_1018"

    def of(self, route: str) -> str:
        return getattr(self, route)


# Which output field each input field becomes.
def common_columns(log: Column) -> list[Column]:
    return _named(
        log["common"], mid="mid", user_id="uid", province_id="ar", channel="ch", is_new="is_new",
        model="md", operate_system="os", version_code="vc", brand="ba",
    )


def page_columns(log: Column) -> list[Column]:
    page = log["page"]
    return [
        *common_columns(log),
        *_named(
            page, page_id="page_id", last_page_id="last_page_id", page_item="item",
            page_item_type="item_type",
        ),
        whole(page["during_time"]).alias("during_time"),
        *_named(page, sourceType="source_type"),
    ]


def display_columns(log: Column, display: Column) -> list[Column]:
    return page_columns(log) + _named(
        display, display_type="display_type", display_item="item", display_item_type="item_type",
        display_order="order", display_pos_id="pos_id",
    )


def action_columns(log: Column, action: Column) -> list[Column]:
    return [
        *page_columns(log),
        *_named(action, action_id="action_id", action_item="item", action_item_type="item_type"),
        whole(action["ts"]).alias("action_ts"),
    ]


def start_columns(log: Column) -> list[Column]:
    start = log["start"]
    return [
        *common_columns(log),
        *_named(start, entry="entry", open_ad_id="open_ad_id"),
        whole(start["loading_time"]).alias("loading_time_ms"),
        whole(start["open_ad_ms"]).alias("open_ad_ms"),
        whole(start["open_ad_skip_ms"]).alias("open_ad_skip_ms"),
    ]


def _named(struct: Column, **fields: str) -> list[Column]:
    """``output="input"`` fields of a struct."""
    return [struct[source].alias(name) for name, source in fields.items()]


def _ts(log: Column) -> Column:
    return whole(log["ts"]).alias("ts")


def split_log(parsed: DataFrame, routes: tuple[str, ...] = ROUTES) -> DataFrame:
    """One row per output of the asked-for routes: adds ``slot(route, display, action)``.

    Page and start are independent, so one record may give both. Displays and actions need a
    page. An error record gives its error output only.
    """
    log, verdict = F.col("log"), F.col("verdict")
    routed = verdict == ROUTED
    has_page = routed & log["page"].isNotNull()
    slots_of = {
        ERROR: F.when(verdict == ERROR, F.array(_slot(ERROR))),
        PAGE: F.when(has_page, F.array(_slot(PAGE))),
        DISPLAY: F.when(
            has_page, F.transform(log["displays"], lambda d: _slot(DISPLAY, display=d))
        ),
        ACTION: F.when(has_page, F.transform(log["actions"], lambda a: _slot(ACTION, action=a))),
        START: F.when(routed & log["start"].isNotNull(), F.array(_slot(START))),
        QUARANTINE: F.when(~verdict.isin(*GOOD), F.array(_slot(QUARANTINE))),
    }
    none = F.array().cast(T.ArrayType(_SLOT))
    slots = F.concat(*[F.coalesce(slots_of[route], none) for route in routes])
    return parsed.withColumn("slot", F.explode_outer(slots)).filter("slot is not null")


_DISPLAY_TYPE = APP_LOG["displays"].dataType.elementType
_ACTION_TYPE = APP_LOG["actions"].dataType.elementType
_SLOT = T.StructType([
    T.StructField("route", T.StringType()),
    T.StructField("display", _DISPLAY_TYPE),
    T.StructField("action", _ACTION_TYPE),
])


def _slot(route: str, display: Column | None = None, action: Column | None = None) -> Column:
    return F.struct(
        F.lit(route).alias("route"),
        (F.lit(None) if display is None else display).cast(_DISPLAY_TYPE).alias("display"),
        (F.lit(None) if action is None else action).cast(_ACTION_TYPE).alias("action"),
    )


def page_log(parsed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed page views, with the record columns in ``carry`` beside them."""
    log = F.col("log")
    return split_log(parsed, (PAGE,)).select(*page_columns(log), _ts(log), *carry)


def page_display_log(parsed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    log = F.col("log")
    return split_log(parsed, (DISPLAY,)).select(
        *display_columns(log, F.col("slot.display")), _ts(log), *carry
    )


def page_action_log(parsed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    log = F.col("log")
    return split_log(parsed, (ACTION,)).select(
        *action_columns(log, F.col("slot.action")), _ts(log), *carry
    )


def start_log(parsed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    log = F.col("log")
    return split_log(parsed, (START,)).select(*start_columns(log), _ts(log), *carry)


def error_log(parsed: DataFrame) -> DataFrame:
    """Error records as they came."""
    return split_log(parsed, (ERROR,)).select("topic", "partition", "offset", "value")


def quarantined_log(parsed: DataFrame) -> DataFrame:
    return split_log(parsed, (QUARANTINE,)).select(
        "topic", "partition", "offset", "value", F.col("verdict").alias("reason")
    )


def unrouted_log(parsed: DataFrame) -> DataFrame:
    """Good records without error, page or start: nothing is emitted for them."""
    kept = F.array(F.when(F.col("verdict") == UNROUTED, F.struct("topic", "partition", "offset", "value")))
    return parsed.select(F.explode_outer(kept).alias("r")).filter("r is not null").select("r.*")


def log_messages(
    parsed: DataFrame, topics: LogTopics = LogTopics(), on_malformed: str = "quarantine"
) -> DataFrame:
    """All outputs as ``(topic, key, value)``, ready for one topic sink.

    ``on_malformed="fail"`` fails the batch on the first record that cannot be routed.
    """
    route = F.col("slot.route")
    gated = split_log(parsed).select(
        "topic", "partition", "offset", "value", "verdict", "slot",
        F.struct(
            F.col("log.common").alias("common"),
            F.when(route.isin(PAGE, DISPLAY, ACTION), F.col("log.page")).alias("page"),
            F.when(route == START, F.col("log.start")).alias("start"),
            F.col("log.ts").alias("ts"),
        ).alias("log"),
    )
    log, slot = F.col("log"), F.col("slot")
    # One record with the fields of all routes: fields a route lacks are NULL here, and NULL
    # fields are left out of the text. A branch per route would generate a method too long for
    # the JVM to compile.
    pages = page_columns(log)
    record = message_json(
        *pages,
        *display_columns(log, slot["display"])[len(pages):],
        *action_columns(log, slot["action"])[len(pages):],
        *start_columns(log)[len(common_columns(log)):],
        _ts(log),
    )
    set_aside = message_json(
        F.col("verdict").alias("reason"), "topic", "partition", "offset", "value"
    )
    if on_malformed == "fail":
        set_aside = F.raise_error(F.concat(F.lit("cannot route record: "), set_aside)).cast("string")
    elif on_malformed != "quarantine":
        raise ValueError(f"on_malformed: quarantine or fail, not {on_malformed}")
    names = [F.lit(x) for name in ROUTES for x in (name, topics.of(name))]
    return gated.select(
        F.element_at(F.create_map(*names), route).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.when(route == ERROR, F.col("value"))
        .when(route == QUARANTINE, set_aside)
        .otherwise(record)
        .alias("value"),
    )
