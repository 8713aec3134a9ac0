"""The streaming jobs.

Each returns a started query; ``awaitTermination`` keeps it running until it is stopped. A
micro-batch returns only after its writes, and Spark records the batch in the checkpoint after
that: at-least-once into Kafka, exactly-once into the table sinks, which know the run and batch.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.change_routes import (
    NO_DATA, NO_ID, ChangeTopics, change_messages, coded_changes, dim_rows, routed_changes,
)
from sluice.operators.log_routes import ROUTES, LogTopics, log_messages
from sluice.operators.parse import (
    BAD_NUMBER, GOOD, MALFORMED, NO_COMMON, NULL_ELEMENT, parse_change, parse_log,
)
from sluice.sources.control import ControlReader
from sluice.sources.files import Files
from sluice.sources.keyed_table import KeyedTable
from sluice.sources.sinks import COMPACT
from sluice.streaming.batch_log import BatchLog

# Fixed value: micro-batch interval of both split jobs.
INTERVAL = {"processingTime": "5 seconds"}
# Takes what is there in as many batches as the source asks for, then stops.
ONCE = {"availableNow": True}

# Default consumer groups.
LOG_GROUP = "ODS_BASE_LOG_GROUP_1018"
DB_GROUP = "ODS_BASE_DB_GROUP_1018"


def run_id(batch: DataFrame) -> str:
    """Id of the running query; it lives in the checkpoint, so it survives restarts and a new
    checkpoint gets a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


VERDICTS = (*GOOD, MALFORMED, NO_COMMON, NULL_ELEMENT, BAD_NUMBER)

# Counts of a batch: records read, their verdicts or reasons, and messages sent, by name.
COUNTS = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("n", T.LongType()),
])


def count_log(spark: SparkSession, path: str) -> BatchLog:
    """A table of counts per batch for the split jobs."""
    return BatchLog(spark, path, COUNTS)


class Counted:
    """Counts taken on a batch's own pass: no job and no reading beside it."""

    def __init__(self, step: str):
        self.step, self.names, self.seen = step, [], Observation()

    def over(self, rows: DataFrame, tests: dict[str, Column]) -> DataFrame:
        """The rows, of which those that pass each test are counted on the way."""
        self.names = list(tests)
        return rows.observe(self.seen, *(F.count_if(test).alias(f"c{i}") for i, test in enumerate(tests.values())))

    def lines(self) -> list[dict]:
        """What was counted, once the rows have been written."""
        found = self.seen.get
        return [{"step": self.step, "name": name, "n": found[f"c{i}"]} for i, name in enumerate(self.names)]


_SETTING = threading.RLock()


@contextmanager
def state_partitions(spark: SparkSession, count: int | None):
    """Starts a stream with ``count`` state partitions, whatever the session's shuffle setting.

    The number is kept in the checkpoint and cannot change later, so choose it for the state the
    stream will come to hold. A query takes the setting when it starts; streams that are started by
    this library wait for each other, so none takes another's number.
    """
    if count is None:
        with _SETTING:
            yield
        return
    key = "spark.sql.shuffle.partitions"
    with _SETTING:
        before = spark.conf.get(key)
        spark.conf.set(key, str(count))
        try:
            yield
        finally:
            spark.conf.set(key, before)


def start_log_split(
    spark: SparkSession,
    source,
    sink,
    checkpoint: str,
    topics: LogTopics = LogTopics(),
    on_malformed: str = "quarantine",
    trigger: dict = INTERVAL,
    counts: BatchLog | None = None,
) -> StreamingQuery:
    """App log to its typed topics: one pass per batch, no shuffle, nothing cached.

    With ``counts``, of :func:`count_log`, each batch tells how many records it read, how many got each
    verdict (the unrouted ones are sent nowhere), and how many messages went to each topic.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        judged, sent = Counted("judged"), Counted("sent")
        parsed = parse_log(batch)
        if counts is not None:
            verdicts = {v: F.col("verdict") == v for v in VERDICTS}
            parsed = judged.over(parsed, {"read": F.lit(True), **verdicts})
        messages = log_messages(parsed, topics, on_malformed)
        if counts is not None:
            messages = sent.over(messages, {t: F.col("topic") == t for t in map(topics.of, ROUTES)})
        sink.write(messages, run_id(batch), batch_id)
        if counts is not None:
            counts.put(run_id(batch), batch_id, judged.lines() + sent.lines())

    return start_batches(source.stream(spark), split, checkpoint, trigger)


def start_change_split(
    spark: SparkSession,
    source,
    control: ControlReader,
    sink,
    dims: KeyedTable,
    checkpoint: str,
    topics: ChangeTopics = ChangeTopics(),
    on_malformed: str = "quarantine",
    key_by_id: bool = False,
    trigger: dict = INTERVAL,
    counts: BatchLog | None = None,
) -> StreamingQuery:
    """Change stream to fact topics and the dimension table.

    The control table is read anew for every batch. Records are decoded and joined once and kept
    for the two sinks, in a folder of the checkpoint rather than in memory, for as long as the batch
    takes; the only shuffle is the one that brings a dimension key's images together.

    With ``counts``, of :func:`count_log`, each batch tells how many records it read, how many of these are
    data changes, and how many became a fact, a dimension row, or were set aside for which reason.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch)
        read, coded, judged = Counted("read"), Counted("coded"), Counted("judged")
        parsed = parse_change(batch)
        if counts is not None:
            parsed = read.over(parsed, {"read": F.lit(True)})
        changes = coded_changes(parsed)
        if counts is not None:
            changes = coded.over(changes, {"changes": ~F.col("malformed")})
        routed = routed_changes(changes, control())
        if counts is not None:
            good = F.col("reason").isNull()
            kinds = {"fact": good & F.col("is_fact"), "dim": good & F.col("is_dim")}
            reasons = {r: F.col("reason") == r for r in (MALFORMED, NO_DATA, NO_ID)}
            routed = judged.over(routed, {"routed": F.lit(True), **kinds, **reasons})
        files, kept = Files(batch.sparkSession, checkpoint), f"kept/batch-{batch_id}"
        try:
            # Facts tell no position; as a column of its own it would be a good part of what is kept.
            told = F.col("is_dim") | F.col("reason").isNotNull()
            routed = routed.withColumns({c: F.when(told, F.col(c)) for c in ("topic", "partition", "offset")})
            routed.write.mode("overwrite").options(**COMPACT).parquet(f"{files.path}/{kept}")
            routed = batch.sparkSession.read.schema(routed.schema).parquet(f"{files.path}/{kept}")
            sink.write(change_messages(routed, topics, on_malformed, key_by_id), run, batch_id)
            dims.upsert(dim_rows(routed), run, batch_id)
            if counts is not None:
                counts.put(run, batch_id, read.lines() + coded.lines() + judged.lines())
        finally:
            files.delete(kept)

    return start_batches(source.stream(spark), split, checkpoint, trigger)


def start_batches(records: DataFrame, batch_fn, checkpoint: str, trigger: dict, partitions: int | None = None) -> StreamingQuery:
    """A started query that hands each batch to a function."""
    with state_partitions(records.sparkSession, partitions):
        return records.writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint).trigger(**trigger).start()
