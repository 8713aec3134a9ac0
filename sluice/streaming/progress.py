"""How far each stream has read, per batch, topic and partition, as a table anyone can query.

Spark reports a batch after it has committed it. The listener writes the offsets it covered, from
where the batch before ended, and how many rows came later than the watermark. A report that is lost with the
driver leaves no gap: the next one begins where the last line in the table ends.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from sluice.sources.topics import OBSERVED
from sluice.streaming.batch_log import BatchLog

PROGRESS = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("at", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("from_offset", T.LongType()),
    T.StructField("to_offset", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("late_rows", T.LongType()),
])


def ranges(report: dict) -> list[dict]:
    """(topic, partition, first, to_offset, rows) of a batch, from Spark's report of it.

    Kafka's offsets name topics and partitions. A file topic observes those of the records it reads; without that
    its files count, under the source's name and partition -1.
    """
    out = []
    observed = {k.removeprefix(OBSERVED): dict(v) for k, v in (report.get("observedMetrics") or {}).items() if k.startswith(OBSERVED)}
    for topic, seen in observed.items():
        for p in sorted(int(k[1:]) for k in seen if k[0] == "n"):
            if seen[f"n{p}"]:
                out.append({"topic": topic, "partition": p, "first": seen[f"f{p}"], "to_offset": seen[f"t{p}"] + 1, "rows": seen[f"n{p}"]})
    for source in report["sources"]:
        start, end = (json.loads(x) if isinstance(x, str) else x for x in (source.get("startOffset"), source.get("endOffset")))
        if not isinstance(end, dict):
            continue
        if "logOffset" in end:
            first = start["logOffset"] + 1 if start else 0
            if not observed and end["logOffset"] + 1 > first:
                out.append({"topic": source["description"], "partition": -1, "first": first, "to_offset": end["logOffset"] + 1, "rows": source["numInputRows"]})
            continue
        for topic, partitions in end.items():
            for p, to in partitions.items():
                first = ((start or {}).get(topic) or {}).get(p, 0)
                out.append({"topic": topic, "partition": int(p), "first": first, "to_offset": to, "rows": to - first})
    return [r for r in out if r["to_offset"] > r["first"]]


def late_rows(report: dict) -> int:
    """Rows that a batch's stateful operators left out as later than the watermark."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for s in report.get("stateOperators", []))


class ProgressListener(StreamingQueryListener):
    """Add it with ``spark.streams.addListener``; one per path."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.log = BatchLog(spark, path, PROGRESS)
        self._ends: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        self._ends.pop(str(event.id), None)

    def onQueryProgress(self, event) -> None:
        self.take(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def take(self, report: dict) -> bool:
        """Writes a batch's lines; False if it is known or has none."""
        query, late = report["id"], late_rows(report)
        if query not in self._ends:
            self._ends[query] = self._read_ends(query)
        ends, lines = self._ends[query], []
        for r in ranges(report):
            key = (r["topic"], r["partition"])
            begin = ends.get(key, r.pop("first"))
            r.pop("first", None)
            if r["to_offset"] > begin:
                lines.append({**r, "from_offset": begin, "run": report["runId"], "at": report["timestamp"], "late_rows": late})
                late = 0  # named once a batch
        if late and not lines:
            lines.append({"run": report["runId"], "at": report["timestamp"], "rows": 0, "late_rows": late})
        if not lines or not self.log.put(query, report["batchId"], lines):
            return False
        ends.update({(x["topic"], x["partition"]): x["to_offset"] for x in lines if "to_offset" in x})
        return True

    def _read_ends(self, query: str) -> dict:
        """Where the lines in the table end: read once a run, a row per partition."""
        rows = self.log.rows(query).filter("to_offset is not null").groupBy("topic", "partition")
        return {(r["topic"], r["partition"]): r["to"] for r in rows.agg(F.max("to_offset").alias("to")).collect()}

    def rows(self, query: str | None = None) -> DataFrame:
        return self.log.rows(query)

    def settled(self, query: StreamingQuery) -> None:
        """Returns when the last batch with input that a query reports has its lines."""
        done = [p["batchId"] for p in map(json.loads, (p.json for p in query.recentProgress)) if ranges(p)]
        if done:
            self.log.wait_for(str(query.id), done[-1])


def positions(progress: DataFrame) -> DataFrame:
    """(query, topic, partition, next_offset): where each query stands."""
    known = progress.filter("to_offset is not null").groupBy("query", "topic", "partition")
    return known.agg(F.max("to_offset").alias("next_offset"))


def gaps(progress: DataFrame) -> DataFrame:
    """Lines that do not begin where the line before of their query and partition ends; none in a whole table."""
    before = F.lag("to_offset").over(Window.partitionBy("query", "topic", "partition").orderBy("batch"))
    return progress.filter("to_offset is not null").withColumn("before", before).filter("before <> from_offset")
