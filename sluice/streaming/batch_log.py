"""What streams tell about their batches, in small files that anyone can query.

A batch's lines are put in place in one step, under the query's id and the number of the batch, so a
replayed batch adds nothing. Every :data:`ROLL` batches they are rolled into one file: a query that has run for
a month of 5 s batches has some 2,000 of them.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.sources.files import Files

ROLL = 256
WIDTH = 12


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        """``schema`` is what :meth:`rows` gives beside ``query`` and ``batch``."""
        self.spark, self.files, self.schema = spark, Files(spark, path), schema

    def put(self, query: str, batch: int, lines: list[dict]) -> bool:
        """Takes a batch's lines; False if they are there already."""
        if batch <= self._rolled(query) or self.files.exists(f"{query}/{batch:0{WIDTH}}.json"):
            return False
        text = "".join(json.dumps({"query": query, "batch": batch, **line}) + "\n" for line in lines)
        self.files.create(f"{query}/{batch:0{WIDTH}}.json", text)
        if batch % ROLL == ROLL - 1:
            self._roll(query, batch)
        return True

    def rows(self, query: str | None = None) -> DataFrame:
        """All lines as columns, of one query or of all."""
        queries = [query] if query else [n for n in self.files.names() if not n.startswith(".")]
        found = [f"{self.files.path}/{q}/{n}" for q in queries for n in self._current(q)]
        schema = T.StructType([T.StructField("query", T.StringType()), T.StructField("batch", T.LongType()), *self.schema])
        return self.spark.read.schema(schema).json(found) if found else self.spark.createDataFrame([], schema)

    def last(self, query: str) -> list[dict]:
        """The lines of the last batch that has any, as they were put."""
        for name in reversed(self._current(query)):
            lines = [json.loads(x) for x in self.files.read(f"{query}/{name}").splitlines()]
            if lines:
                newest = max(x["batch"] for x in lines)
                return [x for x in lines if x["batch"] == newest]
        return []

    def wait_for(self, query: str, batch: int, seconds: float = 60) -> None:
        """Returns when a batch's lines are there; they may come a little after the batch."""
        until = time.time() + seconds
        while batch > self._rolled(query) and not self.files.exists(f"{query}/{batch:0{WIDTH}}.json"):
            if time.time() > until:
                raise TimeoutError(f"no lines of batch {batch} of {query}")
            time.sleep(0.05)

    def _current(self, query: str) -> list[str]:
        """Rolled files, then those of later batches; what is rolled and not yet deleted is left out."""
        names = [n for n in self.files.names(query) if n.endswith(".json") and n[0] != "."]
        rolled = sorted(n for n in names if n.startswith("to-"))
        top = int(rolled[-1][3:-5]) if rolled else -1
        return [*rolled, *sorted(n for n in names if not n.startswith("to-") and int(n[:-5]) > top)]

    def _rolled(self, query: str) -> int:
        return max((int(n[3:-5]) for n in self.files.names(query) if n.startswith("to-")), default=-1)

    def _roll(self, query: str, batch: int) -> None:
        """At most :data:`ROLL` small files become one."""
        top = self._rolled(query)
        names = [n for n in self._current(query) if not n.startswith("to-")]
        self.files.create(f"{query}/to-{batch:0{WIDTH}}.json", "".join(self.files.read(f"{query}/{n}") for n in names))
        for name in self.files.names(query):
            if name.endswith(".json") and name[0] not in ".t" and top < int(name[:-5]) <= batch:
                self.files.delete(f"{query}/{name}")
