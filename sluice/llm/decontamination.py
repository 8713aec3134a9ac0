"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is a run of item words. For it to occur in a document, each of its words must; so its
rarest word, by document frequency over the whole corpus, is a sufficient prefix for exact
containment. Windows are indexed by that word and its place. A document word that is a prefix word
names the only start at which the window can lie; windows that would begin before or end after the
document are passed over, and the words at that start are compared in full.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import reduce

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import documents, map_rows, stored

WINDOW = 10
FOUND = "doc_id long, n_words long, spans array<struct<start: long, end: long>>, items array<string>"
#: Item text in one block. Each block is sent to all tasks, and its index there takes about 40 times as much.
BLOCK_BYTES = 2 << 20

# A-Z become a-z; ASCII that is neither letter nor digit parts words; all else belongs to them.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def split(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def windows(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    """Runs of ``size`` words; fewer words, but not none, are one run."""
    if len(words) < size:
        return [tuple(words)] if words else []
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def frequencies(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """Documents, over the whole corpus, that hold each of the given words."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(words))

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(shared.value.intersection(split(text.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
        )

    each = docs.select(F.col("text").cast("binary")).mapInArrow(count, "word binary, n long")
    return {bytes(word): n for word, n in each.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def prefix_index(items: list[tuple[str, list[bytes]]], frequency: dict[bytes, int], size: int):
    """word -> (place in the window, window length) -> window -> ids of its items."""
    index: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for item, words in items:
        for window in windows(words, size):
            place = min(range(len(window)), key=lambda i: (frequency.get(window[i], 0), window[i], i))
            index[window[place]][place, len(window)][window].add(item)
    return {
        word: [(place, length, {w: sorted(ids) for w, ids in found.items()}) for (place, length), found in places.items()]
        for word, places in index.items()
    }


def occurrences(words: list[bytes], index: dict):
    """(start, length, item ids) of each indexed window that lies in the words."""
    for at in [i for i, word in enumerate(words) if word in index]:
        for place, length, found in index[words[at]]:
            start = at - place
            if 0 <= start <= len(words) - length and (ids := found.get(tuple(words[start : start + length]))):
                yield start, length, ids


def united(spans) -> list[dict[str, int]]:
    """The words that (start, end) pairs cover, as sorted spans that neither overlap nor touch."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": start, "end": end} for start, end in out]


def _index(docs: DataFrame, items: list[tuple[str, list[bytes]]], size: int):
    """The broadcast index of one block of items."""
    frequency = frequencies(docs, {word for _, words in items for word in words})
    return docs.sparkSession.sparkContext.broadcast(prefix_index(items, frequency, size))


def _scan(docs: DataFrame, items: list[tuple[str, list[bytes]]], size: int) -> DataFrame:
    """(row, doc_id, n_words, spans, items) for one block of items."""
    shared = _index(docs, items, size)

    def make():
        def give(doc_id, text):
            words = split(text)
            spans, ids = set(), set()
            for start, length, found in occurrences(words, shared.value):
                spans.add((start, start + length))
                ids.update(found)
            row = xxhash.xxh3_128_digest(b"%r\n" % doc_id + (text or b""))
            return [(row, doc_id, len(words), united(spans), sorted(ids))]

        return give

    rows = docs.select("doc_id", F.col("text").cast("binary"))
    return map_rows(rows, make, f"row binary, {FOUND}")


def _blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """(item_id, text) in parts of about ``block_bytes``, by a hash of the row."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), F.col("text").cast("binary"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    return [rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) for every row of ``docs``.

    spans are the word ranges [start, end) that item windows cover, joined where they touch; items
    are the ids, as strings, of the items with a window there. Items are taken in blocks of about
    ``block_bytes`` of text, each against all documents, so any number of them works. Null texts
    have no words; an item without words never occurs; rows that repeat an item_id are one item,
    and a null item_id is the item ``null``. Document rows are judged one by one, repeated or not, by
    their whole texts, however long; columns beside doc_id and text are not looked at.
    """
    docs = documents(docs)
    scans = [
        _scan(docs, [(item, split(bytes(text))) for item, text in block.collect()], window)
        for block in _blocks(items.filter("text is not null"), block_bytes)
    ]
    if len(scans) == 1:
        return scans[0].drop("row")
    # Further blocks: what they found for a row, told by its id and text, comes together again.
    hits = reduce(DataFrame.union, scans).filter(F.size("items") > 0).groupBy("row")
    hits = hits.agg(F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
    joined = scans[0].select("row", "doc_id", "n_words").join(hits, "row", "left").drop("row")

    def make():
        def give(doc_id, n_words, spans, items):
            return [(doc_id, n_words, united([(s["start"], s["end"]) for s in spans or ()]), sorted(set(items or ())))]

        return give

    return map_rows(joined, make, FOUND)



def uncontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no item window occurs, with all their columns.

    Rows without words, null texts too, stay. Items are taken in blocks as in :func:`contamination`;
    what one block leaves is written before the next, so that a task holds one index.
    """
    blocks = _blocks(items.filter("text is not null"), block_bytes)
    for n, block in enumerate(blocks):
        shared = _index(documents(docs), [(item, split(bytes(text))) for item, text in block.collect()], window)
        docs = docs.filter(~_hit(shared)(F.col("text").cast("binary")))
        if n + 1 < len(blocks):
            docs = stored(docs, "uncontaminated")
    return docs


def _hit(shared):
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series([next(occurrences(split(text), shared.value), None) is not None for text in texts], dtype=bool)

    return F.pandas_udf(judge, "boolean")
