"""A keyed table on parquet: one row per ``(space, id)``, in buckets by space and hash of id.

A batch appends its rows, a delta per bucket it touches; what the table held is not read. A reader
ranks the deltas of a bucket with its older rows and keeps the row that counts per key. Deltas are
merged when :data:`FAN` of the newest ones are alike in size, so a bucket has few of them and a
row is rewritten about log(rows) times over its life. A manifest names the deltas of every bucket
and the last batch taken from each stream. It is put in place in one step, so readers always see
whole batches and a replayed batch is skipped. Merged deltas stay for some days, so a DataFrame
that reads them is not cut off. One writer per table.
"""

from __future__ import annotations

import json
import time
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.rows import first_by, latest_by
from sluice.sources.files import Files

ROW = T.StructType([
    T.StructField("space", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("src_partition", T.IntegerType()),
    T.StructField("src_offset", T.LongType()),
    T.StructField("at", T.LongType()),
])
KEYS = ["space", "id"]
# As stored: with the row image decoded once, and the version that a row came in.
STORED = T.StructType([*ROW, T.StructField("image", T.VariantType()), T.StructField("version", T.LongType())])
BUCKETS = 16
# Deltas of a bucket that are merged at once, at least; each at most twice as large as all newer ones together.
FAN = 8
# Manifests kept; readers hold on to files, not to manifests.
MANIFESTS = 20


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        on_delete: str = "keep",
        wins: str = "last",
        buckets: int | None = None,
        keep_days: float = 7.0,
        images: bool = True,
    ):
        """``on_delete="keep"`` stores a deleted row's image like any other; ``"remove"`` hides it.

        With ``wins="last"`` a later batch replaces a row, within a batch the highest ``(src_offset,
        src_partition)``; with ``"first"`` the smallest ``(at, src_partition, src_offset)`` stays,
        whichever batch it comes in. Choose ``buckets`` (per space) so that a bucket of the largest space suits
        one task; another number than the table has makes the next batch deal its rows out anew.
        With ``images`` the JSON in ``data`` is decoded when it is written and kept beside the text, so
        that lookups read fields; NULL where it is no JSON.
        """
        if on_delete not in ("keep", "remove"):
            raise ValueError(f"on_delete: keep or remove, not {on_delete}")
        if wins not in ("last", "first"):
            raise ValueError(f"wins: last or first, not {wins}")
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)
        self.on_delete, self.wins, self.buckets, self.keep_days, self.images = on_delete, wins, buckets, keep_days, images

    def upsert(self, rows: DataFrame, run: str, batch_id: int) -> bool:
        """Takes one batch; False if this batch of this run was taken before."""
        manifest = self._manifest()
        if batch_id <= manifest["taken"].get(run, -1):
            return False
        if self.buckets and self.buckets != manifest["buckets"]:
            manifest = self._dealt_anew(manifest, self.buckets)
        version, live = manifest["version"] + 1, manifest["live"]
        columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in ROW]
        order = ["src_offset", "src_partition"] if self.wins == "last" else _FIRST
        image = F.try_parse_json("data") if self.images else F.parse_json(F.lit(None).cast("string"))
        delta = self._rank(rows.select(*columns), order).withColumn("image", image)
        for space, bucket, n in self._write(delta, manifest["buckets"], version):
            live.setdefault(space, {}).setdefault(bucket, []).append([version, n])
        manifest = self._commit({**manifest, "version": version, "taken": {**manifest["taken"], run: batch_id}})
        due = [(s, b, k) for s, each in live.items() for b, deltas in each.items() if (k := _mergeable(deltas)) is not None]
        if due:
            self._merge(manifest, due)
        return True

    def current(self, space: str | None = None, ids: DataFrame | None = None, prefix: str = "", images: bool = False) -> DataFrame:
        """The rows of one key space, or of all whose names begin with ``prefix``; with ``images`` decoded ones beside them.

        ``ids`` (one column ``id``) keeps only those rows of a space and opens only their buckets.
        Buckets of one delta are read as they are, the others ranked.
        """
        manifest = self._manifest()
        live = manifest["live"]
        spaces = [s for s in live if s.startswith(prefix)] if space is None else [space]
        wanted = opened = None
        if ids is not None:
            wanted = ids.filter("id is not null").distinct()
            opened = {str(r[0]) for r in wanted.select(_bucket(manifest["buckets"])).distinct().collect()}
        parts = [(s, b, d) for s in spaces for b, d in live.get(s, {}).items() if wanted is None or b in opened]
        found = []
        for one in (True, False):
            folders = [_folder(v, s, b) for s, b, deltas in parts if (len(deltas) == 1) is one for v, _ in deltas]
            if folders:
                rows = self._read(folders)
                rows = rows if wanted is None else rows.join(wanted, "id", "left_semi").select(*STORED.names)
                found.append(rows if one else self._counting(rows))
        rows = self.spark.createDataFrame([], ROW).withColumn("image", F.parse_json(F.lit(None).cast("string"))) if not found else found[0] if len(found) == 1 else found[0].unionByName(found[1])
        if self.on_delete == "remove":
            rows = rows.filter("op is null or op <> 'D'")
        return rows.select(*ROW.names, *(["image"] if images else []))

    def compact(self) -> None:
        """Merges all deltas of every bucket."""
        manifest = self._manifest()
        due = [(s, b, 0) for s, each in manifest["live"].items() for b, deltas in each.items() if len(deltas) > 1]
        if due:
            self._merge(manifest, due)

    def expire(self) -> None:
        """Deletes deltas that were merged more than ``keep_days`` ago."""
        manifest = self._manifest()
        if manifest["version"]:
            self._commit({**manifest, "version": manifest["version"] + 1})

    def _merge(self, manifest: dict, due: list[tuple[str, str, int]]) -> dict:
        """Merges the deltas from the k-th on of each ``(space, bucket, k)``; older ones stay older."""
        version, live = manifest["version"] + 1, manifest["live"]
        taken = {(s, b): live[s][b][k:] for s, b, k in due}
        rows = self._read([_folder(v, s, b) for (s, b), deltas in taken.items() for v, _ in deltas])
        for space, bucket, n in self._write(self._counting(rows), manifest["buckets"], version):
            live[space][bucket] = [*live[space][bucket][: -len(taken[space, bucket])], [version, n]]
        return self._commit(_without(manifest, taken, version))

    def _dealt_anew(self, manifest: dict, buckets: int) -> dict:
        """All rows in another number of buckets."""
        version = manifest["version"] + 1
        taken = {(s, b): deltas for s, each in manifest["live"].items() for b, deltas in each.items()}
        live: dict = {}
        if taken:
            rows = self._read([_folder(v, s, b) for (s, b), deltas in taken.items() for v, _ in deltas])
            for space, bucket, n in self._write(self._counting(rows), buckets, version):
                live.setdefault(space, {})[bucket] = [[version, n]]
        return self._commit({**_without(manifest, taken, version), "buckets": buckets, "live": live})

    def _counting(self, rows: DataFrame) -> DataFrame:
        """The row that counts of each key among several versions."""
        return self._rank(rows, ["version"] if self.wins == "last" else _FIRST)

    def _rank(self, rows: DataFrame, order: list[str]) -> DataFrame:
        return (latest_by if self.wins == "last" else first_by)(rows, KEYS, order)

    def _write(self, rows: DataFrame, buckets: int, version: int) -> list[tuple[str, str, int]]:
        """Writes rows, one per key by now, a bucket to a task; which buckets, and their rows."""
        part = F.concat(F.substring(F.md5("space"), 1, 12), F.lit("-"), _bucket(buckets))
        rows = rows.select(*ROW.names, "image", F.lit(version).cast("long").alias("version"), part.alias("part"))
        rows = rows.repartition("part").sortWithinPartitions("part", *KEYS)
        path = f"{self.path}/data/version={version}"
        rows.write.mode("overwrite").partitionBy("part").parquet(path)
        if not any(n.startswith("part=") for n in self.files.names(f"data/version={version}")):
            return []
        # Of what was written only the spaces are read again: at most a row per space and bucket comes of it.
        held = self.spark.read.schema(T.StructType([ROW["space"], T.StructField("part", T.StringType())])).parquet(path)
        return [(r["space"], r["part"].rpartition("-")[2], r["count"]) for r in held.groupBy("space", "part").count().collect()]

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(*[f"{self.path}/{f}" for f in sorted(folders)])

    def _versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self.files.names("manifest") if n.endswith(".json") and n[0] != ".")

    def _manifest(self) -> dict:
        versions = self._versions()
        if not versions:
            return {"version": 0, "buckets": self.buckets or BUCKETS, "live": {}, "taken": {}, "dropped": []}
        return json.loads(self.files.read(f"manifest/{versions[-1]}.json"))

    def _commit(self, manifest: dict) -> dict:
        """Puts a manifest in place, without the dropped deltas that are due to go.

        These go before: a crash in between leaves them named, and they go again.
        """
        due = time.time() - self.keep_days * 86400
        dropped = manifest.get("dropped", [])
        for _, folder in (gone := [d for d in dropped if d[0] < due]):
            self.files.delete(folder)
        for parent in {folder.rpartition("/")[0] for _, folder in gone}:
            if not any(n.startswith("part=") for n in self.files.names(parent)):
                self.files.delete(parent)
        manifest = {**manifest, "dropped": [d for d in dropped if d[0] >= due]}
        try:
            self.files.create(f"manifest/{manifest['version']}.json", json.dumps(manifest))
        except FileExistsError as there:
            raise RuntimeError(f"{self.path}: another writer committed version {manifest['version']}") from there
        for version in self._versions()[:-MANIFESTS]:
            self.files.delete(f"manifest/{version}.json")
        return manifest


_FIRST = ["at", "src_partition", "src_offset"]


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _folder(version: int, space: str, bucket: str) -> str:
    """Where a bucket's rows of a version lie."""
    return f"data/version={version}/part={md5(space.encode()).hexdigest()[:12]}-{bucket}"


def _mergeable(deltas: list[list[int]]) -> int | None:
    """From which delta on a bucket's newest ones are to be merged; None if they may stay."""
    first, newer = len(deltas) - 1, deltas[-1][1]
    while first and deltas[first - 1][1] <= 2 * newer:
        first -= 1
        newer += deltas[first][1]
    return first if len(deltas) - first >= FAN else None


def _without(manifest: dict, taken: dict, version: int) -> dict:
    """The manifest of a version in which the deltas ``taken`` are replaced."""
    now = time.time()
    gone = [[now, _folder(v, s, b)] for (s, b), deltas in taken.items() for v, _ in deltas]
    return {**manifest, "version": version, "dropped": [*manifest["dropped"], *gone]}
