"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from operator import methodcaller

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.session import scratch_dir

#: Entries of a per-task memo before it starts afresh; bounds a worker's memory on any vocabulary.
MEMO = 300_000
_VALUE = methodcaller("as_py")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """Id and text under the names used here; further columns, whatever their names, stay out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))


def unused(rows: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of ``rows`` is called like it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_keys(docs: DataFrame, names: tuple[str, str] = ("_k1", "_k2")) -> DataFrame:
    """Adds two 64-bit hashes of id and whole text that tell rows apart; equal rows share them."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    return docs.withColumns(dict(zip(names, (F.xxhash64(doc_id, text), F.xxhash64(text, doc_id)))))


#: Folders made within :func:`disposable`, where one is open.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(rows: DataFrame, name: str) -> str:
    """The fresh folder in the shared one that rows were written to."""
    path = scratch_dir(rows.sparkSession, name)
    if (made := _MADE.get()) is not None:
        made.append(path)
    rows.write.parquet(path)
    return path


@contextmanager
def disposable(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the folders that operators wrote within; their results must be written outside by then."""
    token = _MADE.set([])
    try:
        yield
    finally:
        made = _MADE.get() or []
        _MADE.reset(token)
        for path in made:
            discard(spark, path)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Writes rows to the shared folder and reads them back: cuts the lineage, survives lost executors."""
    return rows.sparkSession.read.schema(rows.schema).parquet(written(rows, name))


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder that :func:`written` gave and nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def map_rows(rows: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str, flush: int = 2048) -> DataFrame:
    """For each row the tuples that a function gives for its values; Arrow batches in and out.

    ``make`` runs once per task and returns the function, so it can hold memos and models.
    Values are taken one by one and results handed on every ``flush`` rows, so a task holds one
    input batch and a part of an output batch.
    """
    names = T.StructType.fromDDL(schema).fieldNames()
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give = make()
        out: list[tuple] = []
        for batch in batches:
            for values in zip(*(map(_VALUE, column) for column in batch.columns)):
                out.extend(give(*values))
                if len(out) >= flush:
                    yield packed(out)
                    out = []
        if out:
            yield packed(out)

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], names=names)

    return rows.mapInArrow(run, schema)


class Memo(dict):
    """A dict that computes missing values and forgets all at :data:`MEMO` entries."""

    def __init__(self, compute: Callable):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= MEMO:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def word_hashes() -> Callable[[list[bytes]], np.ndarray]:
    """A function from words to their 64-bit hashes, with a memo of its own."""
    get = Memo(xxhash.xxh64_intdigest).__getitem__
    return lambda words: np.fromiter(map(get, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 one), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def run_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """A hash of each run of ``words`` consecutive words, by its start."""
    if len(hashes) < words:
        return np.zeros(0, np.uint64)
    n = len(hashes) - words + 1
    out = np.zeros(n, np.uint64)
    for i in range(words):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[i : i + n]
    return mixed(out)


def hash_bounds(sizes: list[tuple], most: int) -> F.Column:
    """A map from each key of (key, rows) to a 64-bit hash below which its ``most`` smallest hashes lie.

    Hashes are spread evenly, and there is so much room that a key all but surely has ``most`` below
    its bound; so the smallest ones are found without bringing all of a key's rows together.
    """
    room = most + 10 * most**0.5 + 10
    bound = lambda n: min((1 << 63) - 1, int(-(1 << 63) + (1 << 64) * room / n))
    return F.create_map(*(F.lit(x) for key, n in sizes for x in (key, bound(n))))


#: Bits of a Bloom filter: powers of two, about 16 for each number, within these bounds. The largest has 8 MB to
#: broadcast, whatever it holds; the fuller, the more passes.
BLOOM_BITS = 1 << 18, 1 << 26
#: Words of 64 bits that are a row while the filter is put together.
BLOOM_CHUNK = 1 << 10


class Bloom:
    """A filter of 64-bit numbers, of bounded size: passes all that were put in, and few others."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, numbers: DataFrame) -> Bloom:
        """From a stored table of one long column, which is read twice. Tasks set bits and put them together; 8 MB at most come to the driver."""
        least, most = BLOOM_BITS
        size = min(most, max(least, 1 << (16 * numbers.count() - 1).bit_length())) // 64

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = np.zeros(size, np.uint64)
            for batch in batches:
                places = cls.places(batch.column(0).drop_null().to_numpy(zero_copy_only=False), size).ravel()
                np.bitwise_or.at(words, places >> np.uint64(6), np.uint64(1) << (places & np.uint64(63)))
            yield from chunks(enumerate(words.reshape(-1, BLOOM_CHUNK)))

        def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                for at, bits in zip(*batch.columns):
                    mine = found.setdefault(at.as_py(), np.zeros(BLOOM_CHUNK, np.uint64))
                    mine |= np.frombuffer(bits.as_py(), np.uint64)
            yield from chunks(found.items())

        def chunks(found: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for at, words in found:
                if words.any():
                    columns = [pa.array([at], pa.int32()), pa.array([words.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["at", "bits"])

        schema = "at int, bits binary"
        parts = numbers.mapInArrow(mark, schema).repartition("at").mapInArrow(unite, schema)
        words = np.zeros((size // BLOOM_CHUNK, BLOOM_CHUNK), np.uint64)
        for at, bits in parts.collect():
            words[at] = np.frombuffer(bits, np.uint64)
        return cls(words.ravel())

    @staticmethod
    def places(numbers: np.ndarray, size: int) -> np.ndarray:
        """The two bits of each number among those of ``size`` words."""
        h = mixed(numbers.astype(np.int64).view(np.uint64).copy())
        return np.stack([h, h >> np.uint64(32)], axis=1) & np.uint64(64 * size - 1)

    def passing(self, numbers: np.ndarray) -> np.ndarray:
        """Which of the numbers may be held."""
        places = self.places(numbers, len(self.words))
        return (self.words[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).all(1)


def passing(self, numbers: np.ndarray) -> np.ndarray:
        """Which of the numbers may be held."""
        places = self.places(numbers)
        return (self.words[places >> np.uint64(6)] >> (places & np.uint64(63)) & np.uint64(1)).all(1)


def passing(rows: DataFrame, column: str, bloom: Bloom) -> DataFrame:
    """The rows whose long in ``column`` a filter passes; nulls don't."""
    shared = rows.sparkSession.sparkContext.broadcast(bloom)

    def test(values: pd.Series) -> pd.Series:
        return pd.Series(shared.value.passing(values.to_numpy(np.int64)))

    # A null among them would turn the longs into doubles on the way.
    found = F.pandas_udf(test, "boolean")(F.coalesce(F.col(column), F.lit(0).cast("long")))
    return rows.filter(F.col(column).isNotNull() & found)


def crc32_of_id(doc_id) -> F.Column:
    """crc32 of an id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
