"""Topic sources: Kafka, and files with the same columns where no broker is at hand."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.schemas import TOPIC_RECORD
from sluice.sources.files import Files
from sluice.sources.sinks import COMPACT, side_by_side

LATEST, EARLIEST = "latest", "earliest"
# Name of the metrics in which a file topic's stream tells its offsets: first, last and count per partition.
OBSERVED = "offsets:"
# A start position: "latest", "earliest", or the first offset to read per partition.
Start = str | dict[int, int]


def starting_offsets(topic: str, start: Start, partitions: int | None = None) -> str:
    """Spark's ``startingOffsets`` value, which must name every partition of the topic.

    With the topic's number of ``partitions`` those that ``start`` leaves out begin at their
    earliest record (-2).
    """
    if isinstance(start, str):
        return start
    whole = {**dict.fromkeys(range(partitions or 0), -2), **start}
    return json.dumps({topic: {str(p): o for p, o in sorted(whole.items())}})


@dataclass(frozen=True)
class KafkaTopic:
    """One Kafka topic as string key and value.

    ``start`` counts for the first run of a checkpoint only; afterwards the checkpoint decides.
    """

    servers: str
    topic: str
    start: Start = LATEST
    min_partitions: int | None = None
    partitions: int | None = None
    max_offsets_per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        found = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": starting_offsets(self.topic, self.start, self.partitions),
        }
        if self.min_partitions:
            found["minPartitions"] = str(self.min_partitions)
        if self.max_offsets_per_trigger:
            found["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return {**found, **self.options}

    def stream(self, spark: SparkSession) -> DataFrame:
        raw = spark.readStream.format("kafka").options(**self.reader_options()).load()
        return raw.select(*[F.col(f.name).cast(f.dataType) for f in TOPIC_RECORD])


@dataclass(frozen=True)
class ReplayTopic:
    """A topic kept as parquet files below ``path``, streamed file by file from the first one on.

    Where a stream stands is in its checkpoint alone, so a restart takes up every file since.
    """

    path: str
    topic: str
    max_files_per_trigger: int | None = None
    # Of the topic; with it, a stream's reports name the offsets of the records it has read.
    partitions: int | None = None

    def batch(self, spark: SparkSession) -> DataFrame:
        return self._of_topic(spark.read.schema(TOPIC_RECORD).parquet(self.path))

    def stream(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(TOPIC_RECORD)
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        records = self._of_topic(reader.parquet(self.path))
        if not self.partitions:
            return records
        each = []
        for p in range(self.partitions):
            mine = F.when(F.col("partition") == p, F.col("offset"))
            each += [F.min(mine).alias(f"f{p}"), F.max(mine).alias(f"t{p}"), F.count(mine).alias(f"n{p}")]
        return records.observe(f"{OBSERVED}{self.topic}", *each)

    def append(self, records: DataFrame) -> None:
        """Adds records as new files."""
        records.select(*TOPIC_RECORD.names).write.mode("append").options(**COMPACT).parquet(self.path)

    def dealt(self, records: DataFrame, part: Column) -> Callable[[int], None]:
        """Writes records once, beside the topic, in parts numbered by ``part``; what is returned adds one part.

        For records that are dear to make and come in several steps: filtering them would make them once
        per step. Rows whose ``part`` is NULL belong to no step.
        """
        spark, there = records.sparkSession, f"{self.path}-dealt"
        rows = records.select(*TOPIC_RECORD.names, part.cast("int").alias("_part"))
        with side_by_side(spark):
            rows.write.options(**COMPACT).partitionBy("_part").parquet(there)
        above, _, name = self.path.rpartition("/")
        files = Files(spark, above)

        def add(n: int) -> None:
            files.make(name)
            for file in files.names(f"{name}-dealt/_part={n}"):
                files.move(f"{name}-dealt/_part={n}/{file}", f"{name}/{n}-{file}")

        return add

    def _of_topic(self, records: DataFrame) -> DataFrame:
        return records.filter(F.col("topic") == self.topic)


def next_offsets(records: DataFrame) -> DataFrame:
    """(topic, partition, next_offset) of records: combined per task, a row per partition in the end."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def from_offsets(records: DataFrame, starts: DataFrame) -> DataFrame:
    """The records from ``next_offset`` on, by topic and partition; partitions not named are read whole."""
    met = records.join(starts.select("topic", "partition", "next_offset"), ["topic", "partition"], "left")
    return met.filter(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).select(*records.columns)
