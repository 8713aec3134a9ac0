"""JSON decoding and validation.

A record is decoded once, in a projection of its own, and judged as a whole before anything is
routed. The verdict is a column, not a filter: filters on a decoded column would be pushed below
the projection and decode the text a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.scalars import bad_number
from sluice.schemas import APP_LOG, CHANGE, CORRUPT

# Verdicts of an app-log record. The first three are good records, the rest quarantine reasons.
ERROR, ROUTED, UNROUTED = "error", "routed", "unrouted"
MALFORMED, NO_COMMON, NULL_ELEMENT, BAD_NUMBER = (
    "malformed", "no_common", "null_element", "bad_number",
)
GOOD = (ERROR, ROUTED, UNROUTED)


def decode(records: DataFrame, schema: T.StructType, into: str) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return records.withColumn(into, F.from_json("value", schema, options))


def parse_log(records: DataFrame) -> DataFrame:
    """Adds ``log`` (decoded envelope) and ``verdict``."""
    return decode(records, APP_LOG, "log").withColumn("verdict", _log_verdict(F.col("log")))


def parse_change(records: DataFrame) -> DataFrame:
    """Adds ``chg`` (decoded change envelope)."""
    return decode(records, CHANGE, "chg")


def unreadable(decoded: Column) -> Column:
    """True for NULL, empty and malformed text (empty text sets no corrupt column)."""
    return decoded.isNull() | decoded[CORRUPT].isNotNull()


def _log_verdict(log: Column) -> Column:
    page, start = log["page"], log["start"]
    null_element = F.exists(log["displays"], lambda d: d.isNull()) | F.exists(
        log["actions"], lambda a: a.isNull()
    )
    # An error record is passed on unsplit, so only its syntax matters, not its other fields.
    is_error = log["err"].isNotNull() & (
        log[CORRUPT].isNull() | F.try_parse_json(F.col("value")).isNotNull()
    )
    page_numbers = bad_number(page["during_time"]) | F.exists(
        log["actions"], lambda a: bad_number(a["ts"])
    )
    start_numbers = (
        bad_number(start["loading_time"])
        | bad_number(start["open_ad_ms"])
        | bad_number(start["open_ad_skip_ms"])
    )
    return (
        F.when(log.isNull(), MALFORMED)
        .when(is_error, ERROR)
        .when(log[CORRUPT].isNotNull(), MALFORMED)
        .when(log["common"].isNull(), NO_COMMON)
        .when(page.isNotNull() & F.coalesce(null_element, F.lit(False)), NULL_ELEMENT)
        .when(bad_number(log["ts"]), BAD_NUMBER)
        .when(page.isNotNull() & F.coalesce(page_numbers, F.lit(False)), BAD_NUMBER)
        .when(start_numbers, BAD_NUMBER)
        .when(page.isNotNull() | start.isNotNull(), ROUTED)
        .otherwise(UNROUTED)
    )
