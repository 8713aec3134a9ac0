"""Topic sinks. Both take ``(topic, key, value)`` rows, the topic chosen per row."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.schemas import strings
from sluice.sources.files import Files

# Producer settings for durable delivery.
DURABLE = {"kafka.enable.idempotence": "true", "kafka.acks": "all"}
# Folders of one level that are merged into one of the next.
FAN = 8
# Bytes that a merged file is to have.
FILE_BYTES = 128 << 20
# Written by Spark when all files of a folder are there.
COMPLETE = "_SUCCESS"
# Files that a task keeps open beside each other, and the bytes that each gathers before it writes them out.
OPEN_FILES = 16
ROW_GROUP = 16 << 20


@contextmanager
def side_by_side(spark: SparkSession):
    """Partitioned writes inside open a file per value, up to :data:`OPEN_FILES` a task, and sort nothing.

    A sort by the partition column holds as much of a task's rows as it gets memory for. Write with
    :data:`COMPACT`, since each open file gathers a row group.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# What a task gathers before it writes is on the heap and in no account of Spark's; JSON texts take about two thirds
# of what they take with Parquet's usual codec.
COMPACT = {"parquet.block.size": str(ROW_GROUP), "compression": "zstd"}


@dataclass(frozen=True)
class KafkaSink:
    """Kafka topics. The write returns after every message is acknowledged and fails the batch on
    a send error; a replayed batch is sent again (at least once)."""

    servers: str
    options: dict[str, str] = field(default_factory=dict)

    def writer_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, **DURABLE, **self.options}

    def write(self, messages: DataFrame, run: str, batch_id: int) -> None:
        messages.select("topic", "key", "value").write.format("kafka").options(
            **self.writer_options()
        ).save()


@dataclass(frozen=True, order=True)
class Range:
    """A folder of the batches from ``first`` to ``last``, merged ``level`` times."""

    first: int
    last: int
    level: int

    @property
    def name(self) -> str:
        return f"batches={self.first}-{self.last}-{self.level}"

    @classmethod
    def of(cls, name: str) -> Range:
        return cls(*map(int, name.removeprefix("batches=").split("-")))


@dataclass(frozen=True)
class FileSink:
    """Topics as parquet partitions, a folder per batch. A replayed batch replaces its own files
    (exactly once); ``run`` keeps streams with different checkpoints apart.

    Every :data:`FAN` folders of one level are merged into one that stands for the whole range of their
    batches as soon as it is complete, so n batches are in about FAN log(n) folders. What was merged is
    deleted at the next merge of the level, so that readers have some batches' time to finish.
    """

    path: str

    def write(self, messages: DataFrame, run: str, batch_id: int) -> None:
        spark, here = messages.sparkSession, Range(batch_id, batch_id, 0)
        rows = messages.select("topic", "key", "value", F.lit(batch_id).cast("long").alias("batch_id"))
        with side_by_side(spark):
            rows.write.mode("overwrite").options(**COMPACT).partitionBy("topic").parquet(f"{self.path}/run={run}/{here.name}")
        # The batches before this one are committed; it may come again itself.
        self._merge(spark, run, batch_id)

    def read(self, spark: SparkSession, from_batch: int | None = None, to_batch: int | None = None, run: str | None = None) -> DataFrame:
        """All messages, with the run and batch that wrote them; or those of some batches, both
        ends included, of which only the folders that hold them are opened."""
        files = Files(spark, self.path)
        runs = [run] if run else [n.removeprefix("run=") for n in files.names() if n.startswith("run=")]
        inside = lambda r: (from_batch is None or r.last >= from_batch) and (to_batch is None or r.first <= to_batch)
        found = [f"{self.path}/run={x}/{r.name}" for x in runs for r in current(self._ranges(files, x)) if inside(r)]
        schema = T.StructType([*strings("key value"), T.StructField("batch_id", T.LongType()), *strings("run topic")])
        if not found:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).option("basePath", self.path).parquet(*found)
        if from_batch is not None:
            rows = rows.filter(F.col("batch_id") >= from_batch)
        if to_batch is not None:
            rows = rows.filter(F.col("batch_id") <= to_batch)
        return rows.select(*schema.names)

    def _ranges(self, files: Files, run: str) -> list[Range]:
        """Complete folders of a run."""
        names = [n for n in files.names(f"run={run}") if n.startswith("batches=")]
        return sorted(Range.of(n) for n in names if files.exists(f"run={run}/{n}/{COMPLETE}"))

    def _merge(self, spark: SparkSession, run: str, before: int) -> None:
        files = Files(spark, self.path)
        while (found := mergeable(current(self._ranges(files, run)), before)) is not None:
            whole = Range(found[0].first, found[-1].last, found[0].level + 1)
            folders = [f"run={run}/{r.name}" for r in found]
            schema = T.StructType([*strings("key value"), T.StructField("batch_id", T.LongType()), *strings("topic")])
            rows = spark.read.schema(schema).option("basePath", f"{self.path}/run={run}").parquet(*[f"{self.path}/{f}" for f in folders])
            parts = 1 + sum(map(files.size, folders)) // FILE_BYTES
            # By range of topic and batch: a topic with most messages is cut, too.
            rows = rows.select(*schema.names)
            rows = rows.repartitionByRange(parts, "topic", "batch_id") if parts > 1 else rows.coalesce(1)
            rows = rows.sortWithinPartitions("topic", "batch_id")
            rows.write.mode("overwrite").options(**COMPACT).partitionBy("topic").parquet(f"{self.path}/run={run}/{whole.name}")
            ranges = self._ranges(files, run)
            for old in set(ranges) - set(current(ranges)):
                if old.level < whole.level and old.last < whole.first:
                    files.delete(f"run={run}/{old.name}")


def current(ranges: list[Range]) -> list[Range]:
    """The folders that count: those within no larger one."""
    out: list[Range] = []
    for r in sorted(ranges, key=lambda r: (r.first, -r.last, -r.level)):
        if not out or r.last > out[-1].last:
            out.append(r)
    return out


def mergeable(ranges: list[Range], before: int) -> list[Range] | None:
    """The first :data:`FAN` folders of one level, all of batches before ``before``."""
    for level in sorted({r.level for r in ranges}):
        same = [r for r in ranges if r.level == level and r.last < before]
        if len(same) >= FAN:
            return same[:FAN]
    return None
