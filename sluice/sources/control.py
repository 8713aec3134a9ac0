"""The control table that says which source tables are facts and which are dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.schemas import CONTROL
from sluice.sources.files import Files

# Called once per micro-batch, so a change takes effect in the next batch without a restart.
ControlReader = Callable[[], DataFrame]

# Written by Spark when all files of a folder are there.
COMPLETE = "_SUCCESS"


def _versions(files: Files) -> list[int]:
    """Complete versions, oldest first."""
    names = [n for n in files.names() if n.startswith("version=") and files.exists(f"{n}/{COMPLETE}")]
    return sorted(int(n.removeprefix("version=")) for n in names)


def publish_control(rules: DataFrame, path: str, keep: int = 10) -> None:
    """Puts a whole rule set in place of the last one; an empty one is legal and routes nothing.

    Readers see it when its last file is written, never half of it. The last ``keep`` versions stay.
    """
    files = Files(rules.sparkSession, path)
    begun = [int(n.removeprefix("version=")) for n in files.names() if n.startswith("version=")]
    version = max(begun, default=0) + 1
    rules.select(*CONTROL.names).coalesce(1).write.parquet(f"{files.path}/version={version}")
    for old in _versions(files)[:-keep]:
        files.delete(f"version={old}")


def control_files(spark: SparkSession, path: str) -> ControlReader:
    """Reads the newest complete version of ``(role, table_name)``, looked up anew on every call.

    Without one the call fails, and with it the batch: records wait rather than go unrouted.
    """
    files = Files(spark, path)

    def read() -> DataFrame:
        versions = _versions(files)
        if not versions:
            raise FileNotFoundError(f"{path}: no complete control table")
        return spark.read.schema(CONTROL).parquet(f"{files.path}/version={versions[-1]}")

    return read
