"""Change-stream split: fact topics and dimension rows by a control table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.changes import dim_space, fact_topic, op_code, row_id
from sluice.functions.rows import emit, latest_by
from sluice.functions.scalars import message_json
from sluice.functions.sizes import BROADCAST_ROWS, is_small
from sluice.operators.lookup import small_key_join
from sluice.operators.parse import MALFORMED, unreadable

NO_DATA, NO_ID = "no_data", "no_id"


@dataclass(frozen=True)
class ChangeTopics:
    # Default topic name and suffix.
    source: str = "ODS_BASE_DB_1018"
    suffix: str = "1018"
    # Ours: records that cannot be routed.
    quarantine: str = "QUARANTINE_DB_1018"


def coded_changes(parsed: DataFrame) -> DataFrame:
    """Data changes with their code, and unreadable records; the rest (bootstrap markers, table
    changes) is dropped."""
    chg = F.col("chg")
    malformed, op = unreadable(chg), op_code(chg["type"])
    row = F.struct(
        "topic", "partition", "offset",
        F.when(malformed, F.col("value")).alias("raw"),
        malformed.alias("malformed"),
        chg["type"].alias("type"),
        chg["table"].alias("table_name"),
        chg["data"].alias("data"),
        op.alias("op"),
    )
    return emit(parsed, F.when(malformed | op.isNotNull(), row))


def table_roles(control: DataFrame) -> DataFrame:
    """Control rows ``(role, table_name)`` as one row per table with a flag per role."""
    return control.groupBy(F.col("table_name").alias("ctl_table")).agg(
        F.max(F.col("role") == "fact").alias("is_fact"),
        F.max(F.col("role") == "dim").alias("is_dim"),
    )


def routed_changes(
    coded: DataFrame, control: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Adds ``is_fact``, ``is_dim``, ``id`` and ``reason`` (NULL for good records); tables in
    neither set are dropped. Table names match case-sensitively."""
    small = is_small(control, broadcast_rows)
    # Proven small, so one partition will do: grouping it then takes no shuffle.
    roles = table_roles(control.coalesce(1) if small else control)
    joined = small_key_join(
        coded, roles, "table_name", "ctl_table", spread=["topic", "partition", "offset"], small=small
    )
    is_fact, is_dim = (F.coalesce(F.col(c), F.lit(False)) for c in ("is_fact", "is_dim"))
    return (
        joined.withColumn("is_fact", is_fact)
        .withColumn("is_dim", is_dim)
        .filter("malformed or is_fact or is_dim")
        .withColumn("id", F.when(F.col("is_dim"), row_id(F.col("data"))))
        .withColumn(
            "reason",
            F.when(F.col("malformed"), MALFORMED)
            .when(F.col("data").isNull(), NO_DATA)
            .when(F.col("is_dim") & F.col("id").isNull(), NO_ID),
        )
    )


def fact_rows(routed: DataFrame, topics: ChangeTopics = ChangeTopics()) -> DataFrame:
    """Fact changes with the topic each goes to. Deletes go to a topic of their own."""
    return routed.filter("is_fact and reason is null").select(
        fact_topic(F.col("table_name"), F.col("op"), topics.suffix).alias("topic"),
        "table_name", "op", "data",
    )


def dim_rows(routed: DataFrame) -> DataFrame:
    """Dimension changes with their key space and id."""
    return routed.filter("is_dim and reason is null").select(
        dim_space(F.col("table_name")).alias("space"), "id", "data", "op",
        F.col("partition").alias("src_partition"), F.col("offset").alias("src_offset"),
    )


def latest_dims(dims: DataFrame) -> DataFrame:
    """Newest image per dimension key by source position. A delete overwrites like any change:
    the deleted row's image stays."""
    return latest_by(dims, ["space", "id"], ["src_offset", "src_partition"])


def change_messages(
    routed: DataFrame,
    topics: ChangeTopics = ChangeTopics(),
    on_malformed: str = "quarantine",
    key_by_id: bool = False,
) -> DataFrame:
    """Facts and quarantined records as ``(topic, key, value)``.

    Facts carry no key by default; ``key_by_id`` keys them by row id, which keeps the order of a
    row's changes downstream.
    """
    bad = F.col("reason").isNotNull()
    set_aside = message_json(
        "reason", "topic", "partition", "offset", "table_name", "type", "data", "raw"
    )
    if on_malformed == "fail":
        set_aside = F.raise_error(F.concat(F.lit("cannot route record: "), set_aside)).cast("string")
    elif on_malformed != "quarantine":
        raise ValueError(f"on_malformed: quarantine or fail, not {on_malformed}")
    key = row_id(F.col("data")) if key_by_id else F.lit(None).cast("string")
    return routed.filter("is_fact or reason is not null").select(
        F.when(bad, topics.quarantine)
        .otherwise(fact_topic(F.col("table_name"), F.col("op"), topics.suffix))
        .alias("topic"),
        F.when(~bad, key).alias("key"),
        F.when(bad, set_aside).otherwise(F.col("data")).alias("value"),
    )
