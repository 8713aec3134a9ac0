"""Product codes against plain full scans, and the bounds against exact distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from sluice.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int, entry string, sums long, of_label int"


def some_vectors(n=300, dims=16, seed=5, ids=None):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    out = []
    for i in range(n):
        v = [float(np.float32(c + r.gauss(0, 0.2))) for c in r.choice(centres)]
        out.append((ids(i) if ids else i, v, r.choice([None, 1, 1, 1, 2])))
    return out


def brute(rows, parts, entries, rounds):
    """(vec_id, code, error, label, label error) rows and the codebooks, all distances measured."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    order = lambda i: (i is None, i or 0)
    ids = sorted({k[0] for k in kept}, key=order)[:entries]
    seeds = [min(v for j, v, _ in kept if j == i) for i in ids]
    books = [[cut(v, p) for v in seeds] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, v)[1] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(ids)):
                mine = [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = []
    for i, v, label in kept:
        near = [nearest(p, v) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), label))
    errors = {}
    for _, _, error, label in out:
        errors[label] = errors.get(label, 0) + error
    return sorted(((*row, errors[row[3]]) for row in out), key=repr), books


def compressed(spark, rows, **options):
    df = spark.createDataFrame([(*r, "c", 1, "e", 2, 3) for r in rows], SCHEMA).repartition(4)
    codes, books = vc.compress(df, **options)
    found = vc.with_label_error(codes).collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label"], r["label_error"]) for r in found), key=repr), books.tolist()


CASES = {
    "plain": some_vectors(),
    "ties": [(i, [float(i % 3)] * 16, i % 2) for i in range(60)],
    "repeated": some_vectors(120, ids=lambda i: i % 10) + some_vectors(40) + some_vectors(40),
    "null ids": some_vectors(90, ids=lambda i: None if i % 3 else i),
    "few": some_vectors(3),
    "large": [(i, [float(np.float32(x * 9000)) for x in v], c) for i, v, c in some_vectors(80)],
    "unusable": [
        *some_vectors(50), (-1, None, 1), (-2, [], 1), (-3, [float("nan")] * 16, 1), (-4, [1.0] * 15 + [None], 1), (-5, [float("inf")] * 16, None),
    ],
}


@pytest.mark.parametrize("name", CASES)
def test_codes_equal_full_scans(spark, name):
    rows = CASES[name]
    assert compressed(spark, rows, parts=4, entries=6, rounds=4) == brute(rows, 4, 6, 4)


def test_other_lengths_and_empty_tables(spark):
    rows = some_vectors(40)
    odd = [*rows, (-1, [0.5] * 8, 1), (-2, [0.5] * 7, 1), (-3, [0.5] * 8, 1)]
    assert compressed(spark, odd, parts=4, entries=6, rounds=2) == brute(rows, 4, 6, 2)
    found, books = compressed(spark, [(1, [1.0, 2.0], 1)], parts=4)
    assert found == [] and books == [[]] * 4
    codes, books = vc.compress(spark.createDataFrame([], SCHEMA))
    assert vc.with_label_error(codes).count() == 0 and books.shape[1] == 0


def test_a_hot_label_and_many_labels_are_merged(spark, monkeypatch):
    monkeypatch.setattr(vc, "is_small", lambda side: False)
    rows = some_vectors(80)
    assert compressed(spark, rows, parts=4, entries=6, rounds=1) == brute(rows, 4, 6, 1)


def test_bounds_hold_and_spare_scans():
    r = np.random.default_rng(1)
    centres = r.normal(0, 900, (12, 4, 4))
    x = (centres[r.integers(0, 12, 4000)] + r.normal(0, 150, (4000, 4, 4))).astype(np.int64)
    history, bounds, scans = x[:12].transpose(1, 0, 2)[None].copy(), vc.Bounds.none(len(x), 4), []
    totals = [0] * (4 * 12 * 5)
    for _ in range(8):
        before = bounds.entry.copy()
        scans.append(vc.assign(x, bounds, history))
        for p in range(4):
            exact = vc.distances(x[:, p], history[-1, p])
            assert (bounds.entry[:, p] == exact.argmin(1)).all()
            moved, others = vc.net_moves(history)
            own = np.sqrt(np.take_along_axis(exact, bounds.entry[:, p, None].astype(int), 1)[:, 0])
            upper = bounds.upper[:, p] + moved[bounds.upper_at[:, p], p, bounds.entry[:, p]]
            rest = np.sqrt(np.where(np.arange(12) == bounds.entry[:, p, None], np.inf, exact).min(1))
            lower = bounds.lower[:, p] - others[bounds.lower_at[:, p], p, bounds.entry[:, p]]
            assert (upper * (1 + vc.SLACK) >= own).all() and (lower * (1 - vc.SLACK) <= rest).all()
        totals = [a + b for a, b in zip(totals, vc.changes(x, before, bounds.entry, 12).ravel().tolist())]
        history = np.concatenate([history, vc.moved_entries(history[-1], totals)[None]])
    assert scans[0] == 16000 and scans[-1] < 4000


def test_net_moves_are_never_more_than_drifts():
    history = np.random.default_rng(2).integers(-50, 50, (6, 2, 5, 3))
    moved, others = vc.net_moves(history)
    steps = np.sqrt(np.square(np.diff(history, axis=0)).sum(-1))
    drifts = np.array([steps[t:].sum(0) for t in range(6)])
    assert (moved <= drifts + 1e-9).all()
    for t, p, e in np.ndindex(6, 2, 5):
        assert others[t, p, e] == np.delete(moved[t, p], e).max()


def test_distances_are_exact_for_large_numbers():
    x = np.array([[vc.LIMIT, -vc.LIMIT], [1, 2]])
    assert vc.distances(x, np.array([[-vc.LIMIT, vc.LIMIT], [0, 0]])).tolist() == [[8 * vc.LIMIT**2, 2 * vc.LIMIT**2], [(1 + vc.LIMIT) ** 2 + (2 - vc.LIMIT) ** 2, 5]]
    assert vc.scaled(np.array([1e30, -1e30, -0.0001])).tolist() == [vc.LIMIT, -vc.LIMIT, -1]


def test_digest_and_wrong_options(spark):
    assert vc.codebooks_digest(np.array([[[1, -2]], [[3, 4]]])) == hashlib.sha256(b"1,-2,3,4").hexdigest()
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([], SCHEMA), entries=257)
