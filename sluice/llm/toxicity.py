"""Toxicity: a counterfactually regularised linear classifier of sentences, a text taking its worst.

Labels mark documents, so the fit goes in two steps. Features of whole documents give first weights;
these pick the sentence of each document that looks worst, which takes the document's label. The
final weights come from these sentences by logistic regression, with a penalty on every sentence
that names a group: its identity terms are swapped for others of their kind, and the squared change
of the score is charged. So a group's name alone cannot carry weight.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Memo, documents, hash_bounds, map_rows, stored

# Identity terms that may stand for each other, by kind and language.
IDENTITY = [
    "christian muslim jewish hindu buddhist catholic atheist sikh".split(),
    "christians muslims jews hindus buddhists catholics atheists sikhs".split(),
    "man woman boy girl".split(),
    "men women boys girls".split(),
    "gay lesbian straight bisexual transgender queer".split(),
    "black white asian latino arab african european american".split(),
    "immigrant refugee foreigner native".split(),
    "immigrants refugees foreigners natives".split(),
    "old young disabled deaf blind".split(),
    "mann frau junge mädchen".split(),
    "männer frauen jungen mädchen".split(),
    "christen muslime juden hindus buddhisten".split(),
    "homme femme garçon fille".split(),
    "hommes femmes garçons filles".split(),
    "chrétiens musulmans juifs hindous bouddhistes".split(),
    "hombre mujer chico chica".split(),
    "hombres mujeres chicos chicas".split(),
    "cristianos musulmanes judíos hindúes budistas".split(),
]
SWAP = {term: kind[(i + 1) % len(kind)] for kind in reversed(IDENTITY) for i, term in enumerate(kind)}

BITS = 18
#: Labelled documents of each class that the fit takes at most.
SAMPLE_PER_CLASS = 6000
#: Words that are judged together. Longer sentences are judged by windows of so many, each half over the
#: one before, so that no text's length adds up and no phrase of half a window is cut.
SENTENCE = 32
_TOKENS = re.compile(r"\w+|[.!?\n]+")
BIAS = 1 << BITS


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself and, so that inflections share weight, its beginnings."""
    names = [word] + [f"{word[:n]}*" for n in (4, 5) if len(word) > n]
    return tuple(crc32(name.encode()) >> (32 - BITS) for name in names)


def sentences(text: str) -> list[list[str]]:
    """Lower-cased words by sentence, or by window of a long one; none for a text without words."""
    out: list[list[str]] = []
    words: list[str] = []
    for token in (*_TOKENS.findall(text.lower()), "\n"):
        if token[0] not in ".!?\n":
            words.append(token)
        elif words:
            out += [words[i : i + SENTENCE] for i in range(0, max(1, len(words) - SENTENCE // 2), SENTENCE // 2)]
            words = []
    return out


def swapped(words: list[str]) -> list[str] | None:
    """The sentence with each identity term replaced by another of its kind; None without one."""
    other = [SWAP.get(w, w) for w in words]
    return other if other != words else None


def _features(words: list[str]) -> list[int]:
    return sorted(f for w in set(words) for f in word_features(w))


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, toxic) of at most ``per_class`` documents a class, those with the smallest hashes of their ids."""
    each = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
    ids = each.agg(F.max("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)").withColumn("h", F.xxhash64("label_id"))
    ids = stored(ids, "labelled")
    sizes = [tuple(r) for r in ids.groupBy("toxic").count().collect()]
    if not sizes:
        return documents(docs).limit(0).select("text", F.lit(0).alias("toxic"))
    # Only the rows with small hashes of a class come together, whatever its share.
    low = ids.withColumn("bound", F.try_element_at(hash_bounds(sizes, per_class), F.col("toxic"))).filter("h <= bound")
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy("h", "label_id"))
    ids = low.withColumn("rank", rank).filter(F.col("rank") <= per_class).select("label_id", "toxic")
    rows = documents(docs).filter("text is not null")
    chosen = rows.join(F.broadcast(ids), rows["doc_id"] == ids["label_id"])  # two classes of per_class ids
    return stored(chosen.select("text", F.col("toxic").cast("int").alias("toxic")), "toxicity-sample")


def _first_weights(sample: DataFrame) -> np.ndarray:
    """Log odds of each feature between toxic and other documents, shrunk where it is rare."""

    def make():
        features = Memo(word_features)
        return lambda text, toxic: [(toxic, sorted({f for s in sentences(text) for w in s for f in features[w]}))]

    rows = map_rows(sample, make, "toxic int, features array<int>")
    counts = rows.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")
    )
    total = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for f, b, n in counts.collect():  # at most 2^18 rows
        bad[f], good[f] = b, n - b
    odds = np.log((bad + 1) / (total.get(1, 0) + 2)) - np.log((good + 1) / (total.get(0, 0) + 2))
    return odds * (bad + good) / (bad + good + 3)


def _examples(sample: DataFrame, weights: np.ndarray) -> list[tuple[int, list[int], list[int] | None]]:
    """Of each sampled document the worst sentence, of a clean one also those naming groups or, else, another."""
    shared = sample.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def make():
        def give(text, toxic):
            found = [(s, _features(s)) for s in sentences(text)]
            if not found:
                return []
            found.sort(key=lambda x: (-float(shared.value[x[1]].sum()), x[0]))
            named = [x for x in found if swapped(x[0])][:3]
            take = found[:1] + (named or found[len(found) // 2 :][:1] if not toxic else [])
            return [(toxic, f, _features(other) if (other := swapped(s)) else None) for s, f in take]

        return give

    rows = map_rows(sample, make, "toxic int, features array<int>, other array<int>")
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[1], r[2] or []))


def regression(examples, penalty: float = 1e-5, counterfactual: float = 1.0, steps: int = 600) -> np.ndarray:
    """Weights, bias last, by gradient descent with momentum on the class-balanced logistic loss.

    ``counterfactual`` times the mean squared difference of the scores of a sentence and its
    swapped form is added to the loss.
    """
    if not examples:
        return np.zeros(BIAS + 1, np.float32)
    y = np.array([e[0] for e in examples], np.float64)
    rows = np.repeat(np.arange(len(examples)), [len(e[1]) for e in examples])
    cols = np.array([f for e in examples for f in e[1]], np.int64)
    pairs = [(e[1], e[2]) for e in examples if e[2] is not None]
    p_rows = np.array([i for i, (a, b) in enumerate(pairs) for _ in (*a, *b)], np.int64)
    p_cols = np.array([f for a, b in pairs for f in (*a, *b)], np.int64)
    p_sign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, speed = np.zeros(BIAS + 1), np.zeros(BIAS + 1)
    for _ in range(steps):
        z = np.bincount(rows, w[cols], len(y)) + w[BIAS]
        slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grad = np.bincount(cols, slope[rows], BIAS + 1) + penalty * w
        grad[BIAS] = slope.sum()
        if pairs:
            change = np.bincount(p_rows, w[p_cols] * p_sign, len(pairs)) * (2 * counterfactual / len(pairs))
            grad += np.clip(np.bincount(p_cols, change[p_rows] * p_sign, BIAS + 1), -1, 1)
        speed = 0.9 * speed - 2.0 * grad
        w += speed
    return w.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> np.ndarray:
    """Weights learned from the given (doc_id, toxic) labels; a repeated label counts as toxic if any is.

    The fit takes at most ``per_class`` documents of each class. All zero, so that every score is
    0.5, without usable labels.
    """
    sample = _sample(docs, labels, per_class)
    return regression(_examples(sample, _first_weights(sample)))


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """Adds score, from 0 to 1, to every row: that of the worst sentence of the whole text.

    A null text, or one without words, has the score of no evidence, the bias alone. Rows are
    scored one by one; a column called score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 1 MB

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        weigh = Memo(lambda word: float(w[list(word_features(word))].sum())).__getitem__
        for texts in batches:
            yield pd.Series([_worst(t, weigh, float(w[BIAS])) for t in texts], dtype="float64")

    return docs.withColumn("score", F.pandas_udf(judge, "double")(F.col(text)))


def _worst(text: str | None, weigh, bias: float) -> float:
    worst = max((sum(map(weigh, set(s))) for s in sentences(text)), default=0.0) if text else 0.0
    return 1 / (1 + float(np.exp(-np.clip(bias + worst, -30, 30))))
