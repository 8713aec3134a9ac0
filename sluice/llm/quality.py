"""Quality rules: plain measures of a text, and a log likelihood ratio of hashed n-grams.

Two multinomials over hashed word 1-grams and 2-grams are counted: one from the texts of a trusted
target, one from the whole raw corpus. A text's ratio is the mean over its n-grams of the log of
their probability in the target over that in the raw corpus, so length has no weight. Every text is
judged by one threshold, nothing is drawn at random: a fifth of the trusted documents, told by their
ids, is left out of the target, and the threshold is a lower tolerance bound of theirs, which all but
one in a thousand such documents reach.

Counting the raw corpus moves no text. For the target, a Bloom filter of the trusted ids, of bounded size,
picks the rows that are joined with the ids.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Bloom, crc32_of_id, documents, map_rows, mixed, passing, run_hashes, stored, word_hashes

#: 2 to this power hashed n-grams; counts and ratios of all of them are what is broadcast (512 KB).
BITS = 16
#: The threshold where no trusted document is left out.
THRESHOLD = -0.15
#: Documents like the left-out ones that the threshold may fail, its confidence, room below it, and the grid of ratios.
FAILING = 0.001
CONFIDENCE = 0.95
ROOM = 0.02
GRID = 1000
WINDOW = 5
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\x0c"


def grams(hashes: np.ndarray) -> np.ndarray:
    """Buckets of a text's 1-grams and 2-grams."""
    return np.concatenate([mixed(hashes.copy()), run_hashes(hashes, 2)]) >> np.uint64(64 - BITS)


def gram_counts(docs: DataFrame) -> DataFrame:
    """(bucket, n): n-gram counts over all rows' texts.

    A task adds up its rows first and gives at most 2^16 counts, however common a word is.
    """

    def count(batches):
        hashes = word_hashes()
        counts = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts += np.bincount(grams(hashes((text.as_py() or b"").split())).astype(np.int64), minlength=1 << BITS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (some, counts[some])], names=["bucket", "n"])

    each = docs.select(F.col("text").cast("binary")).mapInArrow(count, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def ratios(raw_counts: DataFrame, target_counts: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of the smoothed probabilities of each bucket; all 0 without target counts."""
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for counts, rows in ((raw, raw_counts), (target, target_counts)):
        for bucket, n in rows.collect():  # at most 2^16 rows
            counts[bucket] = n
    if not target.sum():
        return np.zeros(1 << BITS, np.float32)
    share = lambda x: np.log(x + smoothing) - np.log(x.sum() + smoothing * len(x))
    return (share(target) - share(raw)).astype(np.float32)


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in windows of five words found twice or more in the text."""
    runs = run_hashes(hashes, WINDOW)
    if not len(runs):
        return 0
    _, which, counts = np.unique(runs, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def judge(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, measures, log_ratio, base_failed) of every row; see :func:`quality`."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def make():
        hashes = word_hashes()

        def give(doc_id, text):
            text = text or b""
            found = hashes(text.split())
            n = len(found)
            letters = text.translate(None, _SPACES)
            word_chars = len(letters.decode("utf-8", "replace"))
            symbols = len(text) - len(text.translate(None, _SYMBOLS))
            repeats = repeated_words(found)
            failed = n < 10 or 100 * repeats > 20 * n
            log_ratio = float(shared.value[grams(found)].mean()) if n else 0.0
            return [(doc_id, n, word_chars, symbols, repeated_lines(text), repeats, log_ratio, failed)]

        return give

    return map_rows(
        documents(docs).select("doc_id", F.col("text").cast("binary")),
        make,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "log_ratio double, base_failed boolean",
    )


def tolerance(cells: list[tuple[int, int]]) -> float | None:
    """The lower tolerance bound of (ratio on the grid, count) cells; None without any.

    With :data:`CONFIDENCE`, all but :data:`FAILING` of the population lie above. From some 3,000
    ratios on it is one of them, whatever their distribution. Fewer can't tell so rare a tail: the bound
    is taken from their mean and deviation with an exponential tail, which is heavier than a normal
    one, or is the least of them if that is lower.
    """
    cells = sorted(cells)
    n = sum(c for _, c in cells)
    if not n:
        return None
    allowed = failing_allowed(n)
    if allowed >= 0:
        below = 0
        for cell, count in cells:
            below += count
            if below > allowed:
                return cell / GRID
    mean = sum(x * c for x, c in cells) / n
    deviation = math.sqrt(sum(c * (x - mean) ** 2 for x, c in cells) / max(1, n - 1))
    tail, sure = -NormalDist().inv_cdf(FAILING), NormalDist().inv_cdf(CONFIDENCE)
    # Natrella's factor of one-sided tolerance limits; it grows as n falls and has no value below 3.
    a, b = 1 - sure**2 / (2 * max(2, n - 1)), tail**2 - sure**2 / n
    factor = (tail + math.sqrt(max(0.0, tail**2 - a * b))) / max(a, 0.1)
    heavier = math.log(1 / (2 * FAILING)) / math.sqrt(2) / tail
    return min(cells[0][0], mean - factor * heavier * deviation) / GRID


def failing_allowed(n: int) -> int:
    """How many of n ratios may lie below a bound of the stated confidence; -1 if n is too small for one."""
    if n * FAILING > 100:  # far from the edges the binomial is a normal one
        return math.floor(n * FAILING - NormalDist().inv_cdf(CONFIDENCE) * math.sqrt(n * FAILING * (1 - FAILING))) - 1
    allowed, chance, term = -1, 0.0, math.exp(n * math.log1p(-FAILING))
    while chance + term <= 1 - CONFIDENCE:
        allowed, chance = allowed + 1, chance + term
        term *= (n - allowed) / (allowed + 1) * FAILING / (1 - FAILING)
    return allowed


def calibrated(judged: DataFrame, left_out: DataFrame) -> float:
    """The threshold from the ratios, on a grid, of left-out trusted documents that pass the plain rules."""
    rows = judged.filter("not base_failed").select("doc_id", "log_ratio")
    rows = rows.join(left_out.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi")
    cells = rows.groupBy(F.floor(F.col("log_ratio") * GRID).alias("cell")).count().collect()  # the grid bounds them
    bound = tolerance([tuple(c) for c in cells])
    return THRESHOLD if bound is None else bound - ROOM


def target_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is one of ``ids``: few others than these are shuffled."""
    some = passing(docs, "doc_id", Bloom.of(ids))
    return some.join(ids.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi")


def quality(docs: DataFrame, trusted: DataFrame, threshold: float | None = None) -> DataFrame:
    """(doc_id, measures, log_ratio, base_failed, kept) for every row of ``docs``.

    ``trusted`` holds the doc_id of the target's documents. Raw counts are over all rows of
    ``docs``, repeated ones as often as they occur. A null or empty text has no words, ratio 0 and
    fails; without any trusted document all ratios are 0. Null ids are trusted by nobody. Ties are
    kept: a ratio equal to the threshold passes. Texts are read whole, however long; columns beside id and
    text are not looked at, whatever their names. A given threshold takes the place of the calibrated one.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).filter("trusted_id is not null").distinct()
    left_out = crc32_of_id(F.col("trusted_id")) % 5 == 0
    rows = documents(docs)
    ids = stored(ids, "trusted")
    ratio = ratios(gram_counts(rows), gram_counts(target_rows(rows, ids.filter(~left_out))))
    judged = stored(judge(docs, ratio), "quality")
    least = calibrated(judged, ids.filter(left_out)) if threshold is None else threshold
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= least))
