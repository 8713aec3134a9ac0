"""Product codes of vectors, fitted by exact k-means rounds with norm-of-sum bounds.

Each part of a vector has its own codebook. A round assigns every part to its nearest entry and moves
the entries to the floored means of their parts. Most parts keep their entry, and bounds prove it
without measuring: a part holds the distance to its entry (upper bound) and to the nearest other one
(lower bound), each with the round in which it was measured. The codebooks of all rounds are kept, so

    distance(part, entry now) <= upper + |entry now - entry then|

with the true net displacement since the stamp, the norm of the summed moves. It is never more than the
sum of the moves' norms, which bounds without a stamp must take. Where the bounds cross, the part's own distance is
measured, and all entries are only if that does not settle it. Ties always cross, so results are those of
full scans.

A pass reads the vectors with their bounds, writes both anew and adds, as the last row of each task, what its
changed parts add to and take from the sums of entries. So entries cost a pass nothing that grows with
the vectors, and a lost executor costs its own tasks of one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.functions.sizes import is_small
from sluice.llm.common import discard, stored, written

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Components are held to this many units either way, so that distances and their sums fit a long.
LIMIT = 1 << 27
#: Bounds are kept as 32-bit floats; this widens them by more than their rounding.
SLACK = 1e-5
_CHUNK = 1 << 18


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(:data:`SCALE` x) as integers, held to ±:data:`LIMIT`."""
    return np.clip(np.floor(values * SCALE), -LIMIT, LIMIT).astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries) of integer parts."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 52:  # then doubles are exact, and their product is fast
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([np.square(x - c).sum(1) for c in entries], axis=1)


@dataclass
class Bounds:
    """Of each part (rows, parts): its entry, both bounds, and the rounds in which they were measured."""

    entry: np.ndarray
    upper: np.ndarray
    lower: np.ndarray
    upper_at: np.ndarray
    lower_at: np.ndarray

    @classmethod
    def none(cls, rows: int, parts: int) -> Bounds:
        """Bounds that never hold, and no entry."""
        none = lambda value, kind: np.full((rows, parts), value, kind)
        return cls(none(-1, np.int16), none(np.inf, np.float32), none(0, np.float32), none(0, np.int8), none(0, np.int8))

    def columns(self) -> list[np.ndarray]:
        return [self.entry, self.upper, self.lower, self.upper_at, self.lower_at]


def net_moves(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far entries are from where they were: (round, part, entry), and the farthest other one's."""
    moved = np.sqrt(np.square((history[-1] - history).astype(np.float64)).sum(-1))
    if moved.shape[-1] == 1:
        return moved, np.zeros_like(moved)
    ranked = np.sort(moved, axis=-1)
    most, second = ranked[..., -1:], ranked[..., -2:-1]
    # Where two are the farthest, second is as far as most.
    return moved, np.where(np.arange(moved.shape[-1]) == moved.argmax(-1)[..., None], second, most)


def assign(x: np.ndarray, bounds: Bounds, history: np.ndarray) -> int:
    """Brings bounds (in place) to the last codebook of ``history`` (round, part, entry, position).

    ``x`` is (rows, parts, positions). Returns how many parts were measured against all entries.
    """
    now, scans = len(history) - 1, 0
    moved, others = net_moves(history)
    for p in range(x.shape[1]):
        own = np.maximum(bounds.entry[:, p], 0)
        upper = bounds.upper[:, p] + moved[bounds.upper_at[:, p], p, own]
        lower = (bounds.lower[:, p] - others[bounds.lower_at[:, p], p, own]) * (1 - SLACK)
        open_ = np.flatnonzero(upper * (1 + SLACK) >= lower)
        known = open_[bounds.entry[open_, p] >= 0]
        exact = np.sqrt(np.square(x[known, p] - history[-1, p, own[known]]).sum(1).astype(np.float64))
        bounds.upper[known, p], bounds.upper_at[known, p] = exact, now
        settled = known[exact * (1 + SLACK) < lower[known]]
        scan = np.setdiff1d(open_, settled, assume_unique=True)
        if not len(scan):
            continue
        scans += len(scan)
        each = distances(x[scan, p], history[-1, p])
        rows, nearest = np.arange(len(scan)), each.argmin(1)
        bounds.entry[scan, p] = nearest
        bounds.upper[scan, p] = np.sqrt(each[rows, nearest].astype(np.float64))
        each[rows, nearest] = np.iinfo(np.int64).max
        bounds.lower[scan, p] = np.sqrt(each.min(1).astype(np.float64))
        bounds.upper_at[scan, p] = bounds.lower_at[scan, p] = now
    return scans


def changes(x: np.ndarray, before: np.ndarray, after: np.ndarray, entries: int) -> np.ndarray:
    """(part, entry, position) sums of the parts gained less those lost; the last position counts them."""
    out = np.zeros((x.shape[1], entries, x.shape[2] + 1), np.int64)
    for p in range(x.shape[1]):
        rows = np.flatnonzero(before[:, p] != after[:, p])
        for sign, mine in ((1, after[rows, p]), (-1, before[rows, p])):
            for e in np.unique(mine[mine >= 0]):
                some = rows[mine == e]
                out[p, e, :-1] += sign * x[some, p].sum(0)
                out[p, e, -1] += sign * len(some)
    return out


def moved_entries(codebooks: np.ndarray, totals: list[int]) -> np.ndarray:
    """The floored means of the totals, entries without parts as they were."""
    parts, entries, width = codebooks.shape
    out = codebooks.copy()
    for slot in range(parts * entries):
        *sums, count = totals[slot * (width + 1) : (slot + 1) * (width + 1)]
        if count:
            out[divmod(slot, entries)] = [s // count for s in sums]
    return out


def _lists(rows: np.ndarray, kind: pa.ListType) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, pa.array(rows.ravel(), kind.value_type), type=kind)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def usable(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``dims`` finite components, and these, as doubles."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(lengths) - lengths
    values = flat[starts[rows][:, None] + np.arange(dims)]
    good = np.isfinite(values).all(1)
    return rows[good], values[good]


def _least(ids: list, x: np.ndarray, most: int) -> dict:
    """The smallest vector of each of the ``most`` smallest ids, null the last."""
    out: dict = {}
    wanted = set(sorted(set(ids), key=_last)[:most])
    for i, key in enumerate(ids):
        if key in wanted:
            mine = x[i].tolist()
            if key not in out or mine < out[key]:
                out[key] = mine
    return out


def _last(key) -> tuple:
    return (key is None, key or 0)


def _seeds(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The first codebooks (part, entry, position) from the smallest ids; None without a usable vector.

    A task gives its smallest ids for each length of vector, with the number of such vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, dict]] = {}
        for batch in batches:
            ids, column = batch.column(0).to_pylist(), batch.column(1)
            for dims in set(column.value_lengths().drop_null().to_pylist()):
                if dims < parts or dims % parts:
                    continue
                which, values = usable(column, dims)
                n, least = found.get(dims, (0, {}))
                mine = [ids[i] for i in which]
                fresh = _least(mine, scaled(values), entries)
                both = [*least.items(), *fresh.items()]
                found[dims] = (n + len(which), _least([k for k, _ in both], np.array([v for _, v in both]), entries))
        for dims, (n, least) in found.items():
            columns = [[dims] * len(least), [n] + [0] * (len(least) - 1), list(least), list(least.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = "dims int, n long, vec_id long, x array<long>"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    names, kinds = arrow.names, arrow.types
    found = stored(rows.select("vec_id", "embedding").mapInArrow(run, schema), "least")
    common = found.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).filter("n > 0").first()
    if common is None:
        return None
    least = found.filter(F.col("dims") == common["dims"]).groupBy("vec_id").agg(F.min("x").alias("x"))
    x = np.array([r["x"] for r in least.orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect()], np.int64)
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2)


_STATE = "x array<int>, entry array<smallint>, upper array<float>, lower array<float>, upper_at array<tinyint>, lower_at array<tinyint>"


def _pass(rows: DataFrame, history: np.ndarray, label: str, final: bool) -> DataFrame:
    """One assignment to the last codebooks: the rows with new bounds and what changes, or codes and errors.

    ``rows`` are the source's (vec_id, label, embedding) in the first pass, the pass before's later on.
    """
    fresh = "embedding" in rows.columns
    _, parts, entries, width = history.shape
    schema = f"vec_id long, label {label}, " + ("code string, error long" if final else f"{_STATE}, sums array<long>")
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def state(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray, Bounds]:
        if fresh:
            which, values = usable(batch.column(2), parts * width)
            return batch.take(pa.array(which)), scaled(values).reshape(-1, parts, width), Bounds.none(len(which), parts)
        x, *bounds = batch.columns[2:8]
        x = _matrix(x, parts * width).astype(np.int64).reshape(-1, parts, width)
        return batch, x, Bounds(*(_matrix(c, parts).copy() for c in bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        step = max(1, _CHUNK // (parts * width))
        for whole in batches:
            for at in range(0, len(whole), step):
                batch, x, bounds = state(whole.slice(at, step))
                before = bounds.entry.copy()
                assign(x, bounds, history)
                if final:
                    error = sum(np.square(x[:, p] - history[-1, p, bounds.entry[:, p]]).sum(1) for p in range(parts))
                    code = ["".join(f"{e:02x}" for e in row) for row in bounds.entry.tolist()]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(code, pa.string()), pa.array(error, pa.int64())], schema=arrow)
                    continue
                sums += changes(x, before, bounds.entry, entries)
                held = [x.reshape(len(x), -1), *bounds.columns()]
                lists = [_lists(c, f.type) for c, f in zip(held, list(arrow)[2:8])]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists, pa.nulls(len(x), arrow[-1].type)], schema=arrow)
        if not final:
            last = [pa.nulls(1, f.type) for f in list(arrow)[:-1]]
            yield pa.RecordBatch.from_arrays([*last, pa.array([sums.ravel().tolist()], arrow[-1].type)], schema=arrow)

    return rows.mapInArrow(run, schema)


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable vector, and the codebooks (part, entry, position).

    ``vectors`` has vec_id, embedding and label. A component x counts as floor(4096 x), held to
    ±:data:`LIMIT`. The code has two hex digits a part; the error is the squared distance to the
    entries, summed over parts. Entries start as the parts of the smallest distinct vec_ids
    (null the last; of rows that share an id the smallest vector), fewer if there are fewer ids. Ties go to the
    lower index. Left out are null vectors, those with a null or non-finite component, and those of
    another length than the commonest (the longer of equally common ones) that ``parts`` divides.
    Repeated rows, ids and null ids are rows like others; an empty table gives no rows and no entries.
    Columns beside these three are not looked at. ``entries`` is 256 at most, ``rounds`` 126.
    """
    if not (0 < entries <= 256 and 0 <= rounds <= 126 and parts > 0):
        raise ValueError("entries must be 1 to 256, rounds 0 to 126, parts positive")
    spark = vectors.sparkSession
    embedding = F.col("embedding").cast("array<double>").alias("embedding")
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), embedding)
    label = source.schema["label"].dataType.simpleString()
    seeds = _seeds(source, parts, entries)
    if seeds is None:
        return spark.createDataFrame([], f"vec_id long, label {label}, code string, error long"), np.zeros((parts, 0, 0), np.int64)
    history = seeds[None]
    totals = [0] * seeds[..., 0].size * (seeds.shape[2] + 1)
    rows, last = source, None
    for number in range(rounds):
        path = written(_pass(rows, history, label, final=False), f"codes-round-{number}")
        if last:
            discard(spark, last)
        table, last = spark.read.parquet(path), path
        moved = table.filter("sums is not null").select(F.posexplode("sums").alias("slot", "change"))
        for slot, change in moved.groupBy("slot").agg(F.sum(F.col("change").cast("decimal(38,0)"))).collect():
            totals[slot] += int(change)
        history = np.concatenate([history, moved_entries(history[-1], totals)[None]])
        rows = table.filter("sums is null").drop("sums")
    codes = stored(_pass(rows, history, label, final=True), "codes")
    if last:
        discard(spark, last)
    return codes, history[-1]


def codebooks_digest(codebooks: np.ndarray) -> str:
    """Hex digest of all components in decimals, by part, entry and position."""
    return sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds label_error, the errors summed over equal labels, nulls together (null beyond a long).

    The sums are broadcast if a check proves them small, and merged otherwise.
    """
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    sums = stored(codes.groupBy(F.col("label").alias("of_label")).agg(total.alias("label_error")), "label-errors")
    sums = F.broadcast(sums) if is_small(sums) else sums.hint("merge")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
