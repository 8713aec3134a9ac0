"""The newest image of every dimension key in Spark's own state.

An alternative to the keyed table for those who want no table beside the stream: a streaming aggregate keeps
the image with the highest ``(offset, partition)`` per key in the state store, and the checkpoint is the
table. It is read with Spark's state data source, by key, while the stream goes on or is stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.change_routes import coded_changes, dim_rows, routed_changes
from sluice.operators.parse import parse_change
from sluice.sources.keyed_table import KEYS
from sluice.streaming.jobs import INTERVAL, state_partitions


def newest_images(dims: DataFrame) -> DataFrame:
    """One row per key; partial results are combined in each task before the shuffle."""
    order = F.struct("src_offset", "src_partition")
    return dims.groupBy(*KEYS).agg(F.max_by(F.struct("data", "op", "src_partition", "src_offset"), order).alias("image"))


def start_dim_state(
    spark: SparkSession,
    source,
    control: DataFrame,
    checkpoint: str,
    trigger: dict = INTERVAL,
    partitions: int | None = None,
) -> StreamingQuery:
    """Keeps the newest images in the state below ``checkpoint``.

    ``control`` is taken when the query starts: other rules count from the next start on, for the
    records that come then. ``partitions`` of the state are fixed by the first run.
    """
    changes = coded_changes(parse_change(source.stream(spark)))
    images = newest_images(dim_rows(routed_changes(changes, control)))
    with state_partitions(spark, partitions):
        return (
            images.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )


def dim_state(spark: SparkSession, checkpoint: str, on_delete: str = "keep") -> DataFrame:
    """(space, id, data, op, src_partition, src_offset) as of the last committed batch."""
    if on_delete not in ("keep", "remove"):
        raise ValueError(f"on_delete: keep or remove, not {on_delete}")
    state = spark.read.format("statestore").option("path", checkpoint).load()
    # The buffer of the one aggregate: the image and what it is ordered by.
    image = F.col("value")[state.schema["value"].dataType.names[0]]
    rows = state.select("key.*", image.alias("image")).select(*KEYS, "image.*")
    return rows.filter("op <> 'D'") if on_delete == "remove" else rows
