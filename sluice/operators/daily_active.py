"""Daily active devices: the first page view per device and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.align import align
from sluice.functions.rows import emit, first_by
from sluice.functions.scalars import event_day, event_hour
from sluice.functions.sizes import BROADCAST_ROWS
from sluice.operators.lookup import with_lookups
from sluice.schemas import DAU_INFO


def page_to_dau(pages: DataFrame) -> DataFrame:
    """Page views in the daily-active shape; fields a page view lacks keep their defaults."""
    return align(pages, DAU_INFO)


def first_visits(
    pages: DataFrame, tie: tuple[str, ...] = (), tz: str = "UTC", carry: tuple[str, ...] = ()
) -> DataFrame:
    """First page view per ``(mid, dt)`` by ``ts``, then by the ``tie`` columns; ``carry`` columns stay.

    A view without ``ts`` belongs to no day and is left out.
    """
    # Not a filter, which would be pushed below the decoding of the pages and decode them twice.
    dated = emit(pages, F.when(F.col("ts").isNotNull(), F.struct("*")))
    days = dated.withColumn("_day", event_day(F.col("ts"), tz))
    first = first_by(days, ["mid", "_day"], ["ts", *tie])
    # Dates are written out after the reduction, on fewer rows.
    dated = first.withColumn("dt", F.col("_day").cast("string")).withColumn(
        "hr", event_hour(F.col("ts"), tz)
    )
    return align(dated, DAU_INFO, carry=carry)


def enrich_dau(
    dau: DataFrame, provinces: DataFrame, users: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Fills province and user columns; call it after the reduction, on fewer rows."""
    looked_up = [
        "province_name", "province_iso_code", "province_3166_2", "province_area_code",
        "user_age", "user_gender",
    ]
    joined = with_lookups(
        dau.drop(*looked_up), provinces, users, F.col("province_id"), F.col("user_id"),
        broadcast_rows,
    )
    return align(joined, DAU_INFO, carry=carry)
