"""Best-fit packing of documents into sequences, by linear grouping over the histogram of lengths.

Lengths are at most the capacity, so a plan needs only their histogram: it is made on the driver from
at most ``capacity`` counts, whatever the number of documents, and names for every length and rank
the sequence and offset. Documents never go to the driver.

Large lengths are rounded up within groups of equal cardinality. Over these few sizes the fewest
sequences are a linear program whose configurations are generated as they pay; whole parts of its
solution are taken, the fullest configurations do the rest, and actual lengths take the rounded ones'
places. Rounding costs something where lengths are many, so the same is done with finer groups and
without the program, and once more by best fit alone; the plan with the fewest sequences counts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import documents, map_rows, stored
from sluice.llm.tokens import Encoder

CAPACITY = 1024
END = 2
#: Lengths over this share of the capacity are grouped; the others fill gaps by best fit.
LARGE = 1 / 8
GROUPS = 256
#: Simplex steps for each size, at most.
STEPS = 12
#: Parts that each length is ranked in, so that a length that many documents have is not one task.
SALTS = 256


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the documents' ids and an end id, cut where longer.

    A longer document gives pieces of ``capacity`` ids of which the first takes what is left over.
    A null text is empty and gives its end id alone.
    """
    end = np.array([END], "<u4").tobytes()

    def make():
        encode = Encoder(path)

        def give(doc_id, text):
            ids = encode(text or "") + end
            n = len(ids) // 4
            cuts = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
            return [
                (doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
            ]

        return give

    return map_rows(documents(docs), make, "doc_id long, piece int, start long, length long, ids_crc32 long")


def fullest(sizes: list[int], most: list[int], capacity: int) -> list[int]:
    """How many of each size to take, one of the first at least, for the fullest sequence."""
    reach = np.zeros(capacity + 1, bool)
    reach[sizes[0]] = True
    reached = [reach]
    for size, limit in zip(sizes, [most[0] - 1, *most[1:]]):
        reach = reached[-1].copy()
        for _ in range(min(limit, (capacity - sizes[0]) // size)):
            reach[size:] |= reach[:-size]
        reached.append(reach)
        if reach[capacity]:
            break
    fill = int(np.flatnonzero(reached[-1])[-1])
    take = [1] + [0] * (len(sizes) - 1)
    for i in range(len(reached) - 2, -1, -1):
        while not reached[i][fill]:
            fill -= sizes[i]
            take[i] += 1
    return take


def priced(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration: its value, and how many of each size it takes."""
    best = np.zeros(capacity + 1)
    steps = []
    for size, value in zip(sizes, values):
        before = best
        if value > 0:
            best = before.copy()
            for _ in range(capacity // size):
                more = best[:-size] + value
                if not (more > best[size:] + 1e-12).any():
                    break
                np.maximum(best[size:], more, out=best[size:])
        steps.append(before)
    take, fill = np.zeros(len(sizes), np.int64), capacity
    worth = best[capacity]
    for i in range(len(sizes) - 1, -1, -1):
        while fill >= sizes[i] and best[fill] > steps[i][fill] + 1e-12:
            fill -= sizes[i]
            take[i] += 1
        best = steps[i]
    return float(worth), take


def program(sizes: list[int], counts: list[int], capacity: int) -> tuple[float, list[tuple[np.ndarray, float]]]:
    """The least number of sequences for so many of each size, fractions allowed, and the configurations that give it.

    The simplex method starts from sequences of one size each; a configuration enters while its sizes
    are worth more than a sequence at the current prices. Steps are bounded, and every state is a solution.
    """
    m, b = len(sizes), np.array(counts, float)
    columns = np.diag([capacity // x for x in sizes]).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    for _ in range(STEPS * m):
        worth, take = priced(sizes, inverse.sum(0), capacity)
        if worth <= 1 + 1e-7:
            break
        entering, x = inverse @ take, inverse @ b
        some = entering > 1e-9
        ratio = np.where(some, x / np.where(some, entering, 1), np.inf)
        out = int(ratio.argmin())
        row = inverse[out] / entering[out]
        inverse -= np.outer(entering, row)
        inverse[out] = row
        columns[:, out] = take
    x = np.maximum(inverse @ b, 0)
    return float(x.sum()), [(columns[:, i].astype(np.int64), float(x[i])) for i in np.argsort(-x, kind="stable")]


class _Run:
    """So many sequences of one content: (length, first rank) of each place, by gap left."""

    def __init__(self, gap: int, count: int, places: tuple):
        self.gap, self.count, self.places = gap, count, places

    def split(self, count: int) -> _Run:
        """Takes the first sequences off into a run of their own."""
        first = _Run(self.gap, count, self.places)
        self.count -= count
        self.places = tuple((length, rank + count) for length, rank in self.places)
        return first

    def __lt__(self, other: _Run) -> bool:
        return self.gap < other.gap


def _grouped(counts: dict[int, int], capacity: int, groups: int, optimised: bool = False) -> list[_Run]:
    """Configurations of rounded sizes, filled with the actual large lengths."""
    lengths = sorted(counts, reverse=True)
    first, total = {}, 0
    for length in lengths:
        first[length] = total
        total += counts[length]
    each = -(-total // groups)
    starts = np.array([first[x] for x in lengths], np.int64)
    length_at = lambda place: lengths[int(np.searchsorted(starts, place, "right")) - 1]
    # Equal cardinality: group g holds places [g * each, (g + 1) * each) of the descending order.
    left = [min(each, total - at) for at in range(0, total, each)]
    size = [length_at(at) for at in range(0, total, each)]
    next_place = list(range(0, total, each))
    runs = []

    def chosen():
        """(group and how many of it, sequences): what the program repeats whole, then the fullest."""
        for take, times in program(size, left, capacity)[1] if optimised else []:
            used = [(g, int(k)) for g, k in enumerate(take) if k]
            if whole := min(int(times + 1e-6), *(left[g] // k for g, k in used)):
                yield used, whole
        while any(left):
            open_groups = [g for g, n in enumerate(left) if n]
            take = fullest([size[g] for g in open_groups], [left[g] for g in open_groups], capacity)
            used = [(g, k) for g, k in zip(open_groups, take) if k]
            yield used, min(left[g] // k for g, k in used)

    for used, times in chosen():
        places = []
        for g, k in used:
            places += [next_place[g] + j * times for j in range(k)]
            next_place[g] += k * times
            left[g] -= k * times
        # Substitute the documents: a new run wherever a place comes to the next actual length.
        ends = np.append(starts[1:], total)
        cuts = {0, times}
        for at in places:
            inside = ends[(ends > at) & (ends < at + times)]
            cuts.update(int(e - at) for e in inside)
        ordered = sorted(cuts)
        for a, b in zip(ordered, ordered[1:]):
            content = tuple((x := length_at(at + a), at + a - first[x]) for at in places)
            runs.append(_Run(capacity - sum(x for x, _ in content), b - a, content))
    return runs


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> pd.DataFrame:
    """(length, rank, count, sequence_id, offset): where pieces of a length, by rank, go.

    The ``count`` pieces from that rank on lie at the same offset of consecutive sequences. Lengths over
    ``large`` of the capacity are rounded up within ``groups`` groups of equal cardinality, or four times
    as many without the program; small lengths go, longest first, where they leave the smallest gap. Of
    these plans, and of best fit for all lengths, the one with the fewest sequences counts.
    """
    counts = {x: n for x, n in counts.items() if n}
    heavy = {x: n for x, n in counts.items() if x > capacity * large}
    light = {x: n for x, n in counts.items() if x not in heavy}
    plans = [_filled([], counts, capacity)]
    if heavy:
        plans.append(_filled(sorted(_grouped(heavy, capacity, 4 * groups)), light, capacity))
        plans.append(_filled(sorted(_grouped(heavy, capacity, groups, optimised=True)), light, capacity))
    runs = min(reversed(plans), key=lambda runs: sum(r.count for r in runs))
    rows, sequence = [], 0
    for run in runs:
        offset = 0
        for length, rank in run.places:
            rows.append((length, rank, run.count, sequence, offset))
            offset += length
        sequence += run.count
    return pd.DataFrame(rows, columns=["length", "rank", "count", "sequence_id", "offset"], dtype="int64")


def _filled(runs: list[_Run], counts: dict[int, int], capacity: int) -> list[_Run]:
    """Sorted runs with further lengths in them, longest first, each where it leaves the smallest gap."""
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(runs, length, key=lambda r: r.gap)
            if at == len(runs):
                each = capacity // length
                full = max(1, left // each)
                within = min(each, left)
                content = tuple((length, rank + j * full) for j in range(within))
                insort(runs, _Run(capacity - length * within, full, content))
                left, rank = left - full * within, rank + full * within
                continue
            run = runs.pop(at)
            if run.count > left:
                rest = run
                run = rest.split(left)
                insort(runs, rest)
            placed = _Run(run.gap - length, run.count, (*run.places, (length, rank)))
            insort(runs, placed)
            left, rank = left - run.count, rank + run.count
    return runs


def _lookup(shared):
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        places = shared.value
        out = np.zeros((len(length), 2), np.int64)
        for each in length.unique():
            first, sequence, offset = places[each]
            here = (length == each).to_numpy()
            ranks = rank[here].to_numpy()
            at = np.searchsorted(first, ranks, "right") - 1
            out[here, 0] = sequence[at] + ranks - first[at]
            out[here, 1] = offset[at]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    return F.pandas_udf(find, "sequence_id long, offset long")


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32), of 1 to ``capacity`` ids.

    Pieces of full length are sequences by themselves. The others are ranked within their length,
    each length in :data:`SALTS` parts, and find their place by length and rank in a table of at
    most some ten thousand rows. Equal rows are interchangeable, so ties do no harm; no rows give none.
    """
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS))
    salted = stored(rows.withColumn("salt", salt), "pieces")
    short = salted.filter(F.col("length") < capacity)
    parts = short.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = plan(counts, capacity).sort_values(["length", "rank"])
    places = {x: tuple(g[c].to_numpy() for c in ("rank", "sequence_id", "offset")) for x, g in table.groupby("length")}
    shared = rows.sparkSession.sparkContext.broadcast(places)
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = short.join(F.broadcast(parts.select("length", "salt", "base")), ["length", "salt"])  # capacity x SALTS rows
    ranked = ranked.withColumn("rank", F.col("base") + F.row_number().over(within) - 1)
    ranked = ranked.withColumn("place", _lookup(shared)("length", "rank"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    packed = ranked.select(*columns, "place.sequence_id", "place.offset")
    alone = salted.filter(F.col("length") == capacity)
    alone = alone.select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(alone)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenizes every row's whole text and packs its pieces; see :func:`pieces` and :func:`pack`."""
    return pack(pieces(docs, path, capacity), capacity)
