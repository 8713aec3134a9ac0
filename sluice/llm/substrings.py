"""Substring deduplication: relative Lempel-Ziv factors of documents against indexed reference text.

The reference is the corpus before a document (smaller ids) and the document before a place. It is
indexed by its windows of :data:`WINDOW` words: the hash of a window leads to its earliest start. A
document is parsed greedily: a factor starts where a window has an earlier occurrence and grows
while the next window's is the next one there; at its end the next window is looked up by itself,
so windows across factor boundaries are checked like all others. Factors of a window or more are
duplicate spans.

Only windows that can repeat are indexed. The smallest hash of the runs of :data:`ANCHOR` words in a
window is its anchor; equal windows have equal anchors, and neighbouring windows mostly share
theirs. Bloom filters of bounded size pass on what matters and little else: rows that are the first copy of their
text, the anchors that two texts or two places share, the texts that hold such anchors, and the
windows found twice. Windows are compared by hash after that, so what a filter lets through in
vain costs time and changes nothing. Copies of a whole text are told by its digest first and take no
part, since their first one stands for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sluice.llm.common import Bloom, discard, documents, map_rows, mixed, passing, run_hashes, stored, written

WINDOW = 20
ANCHOR = 8
#: Bytes of text that a task works on at once; one text can be longer.
SLICE = 1 << 20
#: Bytes of the longest word that is hashed among others.
SHORT = 64
#: The place of a null id: after all others.
LAST = (1 << 63) - 1
FACTORS = "array<struct<start: int, length: int, ref_id: long, ref_start: int>>"
NOTHING = sha256(b"").hexdigest()


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least (np.minimum) or largest (np.maximum) of each ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    done = 1
    while done < width:  # over 1, 2, 4, ... values, then over what is left
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def anchors(runs: np.ndarray, window: int) -> np.ndarray:
    """The anchor of each window, from the hashes of the shorter runs."""
    return sliding(runs, window - ANCHOR + 1, np.minimum)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about :data:`SLICE` bytes of text, the last column; a longer text is one by itself."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
        ends = np.append(0, np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of many words at once: words of up to :data:`SHORT` bytes by 8 bytes after 8, longer ones by xxHash."""
    _, offsets, text = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset :][: len(words) + 1].astype(np.int64)
    data = np.append(np.frombuffer(text or b"", np.uint8)[: ends[-1]], np.zeros(8, np.uint8))
    starts, sizes = ends[:-1], np.diff(ends)
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = mixed(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    some = np.flatnonzero(sizes <= SHORT)
    for done in range(0, SHORT, 8):
        some = some[sizes[some] > done]
        if not len(some):
            break
        kept = np.minimum(sizes[some] - done, 8).astype(np.uint64) * np.uint64(8)
        out[some] = mixed(out[some] ^ eights[starts[some] + done] & np.uint64(2**64 - 1) >> (np.uint64(64) - kept))
    for i in np.flatnonzero(sizes > SHORT).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i + 1]])
    return out


class Words:
    """The words of a slice's texts, one text after the other; all are worked on at once."""

    def __init__(self, texts: pa.Array):
        # As strings, since the kernels take no bytes; they look at ASCII alone and check nothing.
        plain = pc.ascii_trim_whitespace(texts.cast(pa.binary()).view(pa.string()))
        self.lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(plain, ""), None, plain))
        self.hashes = hashed(self.lists.flatten())
        self.counts = pc.fill_null(pc.list_value_length(self.lists), 0).to_numpy(zero_copy_only=False)
        self.ends = np.cumsum(self.counts, dtype=np.int64)
        #: The text of each word.
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def inside(self, window: int) -> np.ndarray:
        """Which windows end in the text that they start in, by their start."""
        n = max(0, len(self.text) - window + 1)
        return self.text[:n] == self.text[window - 1 :]

    def digests(self) -> list[bytes]:
        joined = pc.binary_join(self.lists, " ").view(pa.binary()).to_pylist()
        return [sha256(text or b"").digest() for text in joined]


def _lists(values: np.ndarray, texts: np.ndarray, n: int) -> pa.Array:
    """Values in the order of their texts as a list for each of ``n`` texts."""
    offsets = np.append(0, np.cumsum(np.bincount(texts, minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, at, same, text): a row's place among all, and a hash that tells texts of one place apart."""
    at = F.coalesce("doc_id", F.lit(LAST))
    return docs.select("doc_id", at.alias("at"), F.xxhash64("text").alias("same"), F.col("text").cast("binary").alias("text"))


def _parsed(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, at, same, n_words, digest, text_key, anchors, again) of every row.

    ``anchors`` are the distinct ones of a text's windows, ``again`` those of them that windows have at two places.
    """
    schema = "doc_id long, at long, same long, n_words long, digest binary, text_key long, anchors array<long>, again array<long>"
    names = T.StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, n = Words(batch.column(3)), batch.num_rows
            runs = run_hashes(words.hashes, ANCHOR)
            of = np.where(words.inside(window), anchors(runs, window), 0)
            # A run is an anchor where a window that covers it has no smaller one.
            around = np.zeros(window - ANCHOR, np.uint64)
            at = np.flatnonzero(sliding(np.concatenate([around, of, around]), window - ANCHOR + 1, np.maximum)[: len(runs)] == runs)
            order = np.lexsort((runs[at], words.text[at]))
            found, texts = runs[at][order].view(np.int64), words.text[at][order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
            twice = np.zeros(len(found), bool)
            twice[1:] = new[:-1] & ~new[1:]
            digests = words.digests()
            keys = np.frombuffer(b"".join(d[:8] for d in digests), "<i8")
            lists = (_lists(found[some], texts[some], n) for some in (new, twice))
            columns = [*batch.columns[:3], pa.array(words.counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return _keyed(docs).mapInArrow(run, schema)


def _shared_anchors(parsed: DataFrame, firsts: DataFrame) -> Bloom:
    """The anchors that two texts share or one has twice.

    Copies have their first one's text_key, so letting some through shares no anchor.
    """
    place = F.xxhash64("at", "text_key")
    rows = passing(parsed.select("at", "text_key", "anchors").withColumn("place", place), "place", Bloom.of(firsts.select(place.alias("place"))))
    each = rows.select("text_key", F.explode("anchors").alias("anchor"))
    met = each.groupBy("anchor").agg(F.min("text_key").alias("x"), F.max("text_key").alias("y")).filter("x <> y")
    twice = parsed.select(F.explode("again").alias("anchor"))
    return Bloom.of(stored(met.select("anchor").unionByName(twice), "shared-anchors"))


def _with_any(rows: DataFrame, column: str, bloom: Bloom) -> DataFrame:
    """The rows with an element of an array that a filter passes."""
    shared = rows.sparkSession.sparkContext.broadcast(bloom)

    def test(lists: pd.Series) -> pd.Series:
        return pd.Series([len(x) > 0 and bool(shared.value.passing(np.asarray(x, np.int64)).any()) for x in lists], dtype=bool)

    return rows.filter(F.pandas_udf(test, "boolean")(F.col(column)))


def _candidates(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(at, text_key, text) of the wanted (at, same, text_key), once each: few other texts are moved."""
    rows = passing(_keyed(docs).drop("doc_id").filter("text is not null"), "same", Bloom.of(wanted.select("same")))
    met = rows.join(wanted.hint("merge"), ["at", "same"]).dropDuplicates(["at", "same"])
    return met.select("at", "text_key", "text")


def _windows(candidates: DataFrame, window: int, held: Bloom, repeated: Bloom | None = None) -> DataFrame:
    """(hash, at, text_key, start) of the windows whose anchor is held, and that may be repeated."""
    context = candidates.sparkSession.sparkContext
    shared = context.broadcast((held, repeated))
    schema = "hash long, at long, text_key long, start int"
    names = T.StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, repeated = shared.value
        for batch in slices(batches):
            words = Words(batch.column(2))
            of = anchors(run_hashes(words.hashes, ANCHOR), window)
            if not len(of):
                continue
            # Neighbours mostly share their anchor, so each run of equal ones is looked up once.
            new = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            some = np.repeat(held.passing(of[new].view(np.int64)), np.diff(np.append(new, len(of))))
            starts = np.flatnonzero(some & words.inside(window))
            keys = run_hashes(words.hashes, window)[starts].view(np.int64)
            if repeated is not None:
                some = repeated.passing(keys)
                starts, keys = starts[some], keys[some]
            text = words.text[starts]
            at, text_key = (c.to_numpy(zero_copy_only=False)[text] for c in batch.columns[:2])
            places = (starts - (words.ends - words.counts)[text]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (keys, at, text_key, places)], names=names)

    return candidates.mapInArrow(run, schema)


def factors(texts: np.ndarray, starts: np.ndarray, ref_ids: np.ndarray, ref_starts: np.ndarray, window: int) -> list[np.ndarray]:
    """Greedy parse: the starts of texts' repeated windows, with their earliest occurrences, to factors (text, start, length, ref_id, ref_start)."""
    order = np.lexsort((starts, texts))
    texts, starts, ref_ids, ref_starts = (x[order] for x in (texts, starts, ref_ids, ref_starts))
    goes_on = (np.diff(texts) == 0) & (np.diff(starts) == 1) & (np.diff(ref_ids) == 0) & (np.diff(ref_starts) == 1)
    first = np.flatnonzero(np.append(True, ~goes_on)) if len(starts) else order
    runs = np.diff(np.append(first, len(starts)))
    return [texts[first], starts[first], runs + window - 1, ref_ids[first], ref_starts[first]]


def _factors(candidates: DataFrame, window: int, held: Bloom) -> DataFrame:
    """(at, text_key, factors) of the texts that have any."""
    rows = _windows(candidates, window, held).select("hash", "at", "start")
    earliest = rows.groupBy("hash").agg(F.min(F.struct("at", "start")).alias("first"), F.count("*").alias("k")).filter("k > 1")
    earliest = stored(earliest.select("hash", "first"), "repeated-windows")
    rows = _windows(candidates, window, held, Bloom.of(earliest.select("hash")))
    met = rows.join(earliest.hint("merge"), "hash")
    met = met.filter((F.col("at") != F.col("first.at")) | (F.col("start") != F.col("first.start")))
    found = F.collect_set(F.struct("start", F.col("first.at").alias("ref"), F.col("first.start").alias("ref_start")))
    each = met.groupBy("at", "text_key").agg(found.alias("found"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            fields = [f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten()]
            texts = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            of, *values = factors(texts, *fields, window)
            each = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(values, kind.value_type)], fields=list(kind.value_type))
            offsets = np.append(0, np.cumsum(np.bincount(of, minlength=len(lists)))).astype(np.int32)
            parsed = pa.ListArray.from_arrays(offsets, each, type=kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], parsed], names=["at", "text_key", "factors"])

    kind = to_arrow_type(T.StructType.fromDDL(f"f {FACTORS}")["f"].dataType)
    return each.mapInArrow(parse, f"at long, text_key long, factors {FACTORS}")


def _cut(text: bytes, spans) -> tuple[int, str]:
    """Words that spans cover, and the digest of the others."""
    words = text.split()
    edges = np.zeros(len(words) + 1, np.int64)
    for f in spans:
        edges[f["start"]] += 1
        edges[f["start"] + f["length"]] -= 1
    gone = np.cumsum(edges[:-1]) > 0
    return int(gone.sum()), sha256(b" ".join([w for w, g in zip(words, gone) if not g])).hexdigest()


def substring_duplicates(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, factors) for every row of ``docs``.

    A factor (start, length, ref_id, ref_start) is a run of words that occurs from word ref_start of
    document ref_id on, earlier than here. n_removed counts the words in factors, kept_sha256 is
    the digest of the others joined by spaces. Windows are told by 64-bit hashes. All windows are
    judged on the input, so a copy of a whole text loses all its words if it has ``window`` of
    them; its factor then is the first copy. Null texts have no words. Rows that share an id are
    one document: equal rows have equal results, and of different texts the earlier start counts.
    A null id comes after all others, as ref_id too. Texts are read whole, however long; other
    columns are not looked at. An empty table gives no rows.
    """
    docs = documents(docs)
    spark = docs.sparkSession
    path = written(_parsed(docs, window), "parsed")
    wide = spark.read.parquet(path)
    parsed = wide.select("doc_id", "at", "same", "n_words", "digest", "text_key")
    first = parsed.groupBy("digest").agg(F.min("at").alias("first_at"))
    parsed = stored(parsed.join(first.hint("merge"), "digest"), "places")
    firsts = parsed.filter(F.col("at") == F.col("first_at")).filter(F.col("n_words") >= window)
    firsts = stored(firsts.groupBy("at", "text_key").agg(F.min("same").alias("same")), "first-copies")
    held = _shared_anchors(wide, firsts)
    with_any = _with_any(wide.select("at", "text_key", "anchors"), "anchors", held).select("at", "text_key").distinct()
    wanted = stored(firsts.join(with_any.hint("merge"), ["at", "text_key"]), "wanted")
    discard(spark, path)
    candidates = stored(_candidates(docs, wanted), "candidates")
    found = stored(_factors(candidates, window, held), "factors")

    def make():
        return lambda at, text_key, text, spans: [(at, text_key, *_cut(text, spans), spans)]

    met = candidates.join(found.hint("merge"), ["at", "text_key"]).select("at", "text_key", "text", "factors")
    cut = map_rows(met, make, f"at long, text_key long, n_cut long, cut_sha256 string, factors {FACTORS}", flush=256)
    copy = (F.col("at") > F.col("first_at")) & (F.col("n_words") >= window)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("length"), F.col("first_at").alias("ref_id"), F.lit(0).alias("ref_start")))
    return parsed.join(cut.hint("merge"), ["at", "text_key"], "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("cut_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("factors", F.array().cast(FACTORS))).alias("factors"),
    )
