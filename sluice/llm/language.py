"""Language identification: family first, then pairwise linear support vector machines within it."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import hash_bounds, map_rows, stored, unused

# Language families by ISO 639-1 code. A language not named is a family of its own.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "uralic": ["et", "fi", "hu"],
    "semitic": ["ar", "he", "mt"],
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}

#: Hashed byte 3-gram features; rows of each language that the fit takes at most.
FEATURES = 4096
SAMPLE_PER_LANGUAGE = 400
#: Languages that a fit learns, the commonest ones; with the sample it bounds the model.
MAX_LANGUAGES = 256
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
PIECE = 1 << 20


def features(text: str) -> np.ndarray:
    """Unit vector of damped counts of hashed byte 3-grams of the whole lower-cased text."""
    raw = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    counts = np.zeros(FEATURES, np.int64)
    for at in range(0, len(raw) - 2, PIECE):
        part = raw[at : at + PIECE + 2].astype(np.uint32)
        grams = part[:-2] << np.uint32(16) | part[1:-1] << np.uint32(8) | part[2:]
        grams *= np.uint32(0x9E3779B1)
        counts += np.bincount(grams >> np.uint32(20), minlength=FEATURES)
    damped = np.sqrt(counts.astype(np.float32))
    return damped / max(np.linalg.norm(damped), 1e-9)


def support_vectors(rows: np.ndarray, signs: np.ndarray, steps: int = 400, penalty: float = 1e-3) -> np.ndarray:
    """Weights, bias last, of a linear SVM: averaged subgradient descent on the class-balanced hinge loss."""
    x = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    weight = np.where(signs > 0, 0.5 / max((signs > 0).sum(), 1), 0.5 / max((signs < 0).sum(), 1)).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    total = np.zeros_like(w)
    for step in range(1, steps + 1):
        wrong = signs * (x @ w) < 1
        w -= (penalty * w - (weight * signs * wrong) @ x) / (penalty * (step + 20))
        total += w * step
    return total / (steps * (steps + 1) / 2)


class Hierarchy:
    """Linear machines: one against the rest over families, one against one within each."""

    def __init__(self, rows: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({FAMILY.get(x, x) for x in self.langs})
        lang, family = np.array(langs), np.array([FAMILY.get(x, x) for x in langs])
        self.members = {f: [x for x in self.langs if FAMILY.get(x, x) == f] for f in self.families}
        over = self.families if len(self.families) > 2 else self.families[:1] * (len(self.families) == 2)
        self.top = [support_vectors(rows, np.where(family == f, 1, -1).astype(np.float32)) for f in over]
        self.pairs = {
            pair: support_vectors(rows[take], np.where(lang[take] == pair[0], 1, -1).astype(np.float32))
            for members in self.members.values()
            for pair in combinations(members, 2)
            for take in [np.isin(lang, pair)]
        }

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """Language and score; ties go to the first name."""
        margin = lambda w: float(x @ w[:-1] + w[-1])
        if len(self.families) == 1:
            family, score = self.families[0], 1.0
        elif len(self.families) == 2:
            at = margin(self.top[0])
            family, score = self.families[0 if at >= 0 else 1], squash(abs(at))
        else:
            margins = [margin(w) for w in self.top]
            best = int(np.argmax(margins))
            family, score = self.families[best], squash(margins[best])
        members = self.members[family]
        votes, least = dict.fromkeys(members, 0), dict.fromkeys(members, np.inf)
        for pair in combinations(members, 2):
            at = margin(self.pairs[pair])
            won = pair[0] if at >= 0 else pair[1]
            votes[won] += 1
            least[won] = min(least[won], abs(at))
        lang = max(members, key=lambda m: (votes[m], -members.index(m)))
        return lang, score * (squash(least[lang]) if len(members) > 1 and votes[lang] else 1.0)


def squash(margin: float) -> float:
    return float(1 / (1 + np.exp(-2 * np.clip(margin, -30, 30))))


def sampled(examples: DataFrame, per_language: int, max_languages: int) -> DataFrame:
    """(lang, text) rows: of the commonest languages the distinct texts with the smallest hashes.

    How many distinct texts a language has tells below which hash its smallest ones lie, so only
    these few, not all of a language, are brought together and ranked.
    """
    usable = examples.select("lang", "text").filter("text is not null and lang is not null")
    usable = usable.withColumn("h", F.xxhash64("text"))
    hashes = stored(usable.select("lang", "h").distinct(), "language-hashes")
    sizes = hashes.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not sizes:
        return usable.limit(0).select("lang", "text")
    bounds = hash_bounds([tuple(r) for r in sizes], per_language)
    low = hashes.withColumn("bound", F.try_element_at(bounds, F.col("lang"))).filter("h <= bound")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = stored(low.select("lang", "h", rank.alias("rank")).filter(F.col("rank") <= per_language), "language-sample")
    # At most max_languages x per_language hashes.
    taken = usable.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"], "left_semi")
    return taken.dropDuplicates(["lang", "h"]).select("lang", "text")


def fit(examples: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Hierarchy | None:
    """Fits on (text, lang) rows with both given and a letter in the text.

    The fit takes at most ``per_language`` texts of each of the ``max_languages`` languages with the most
    distinct texts (ties by name), those with the smallest hash of the text, so equal input gives an
    equal model; rarer values of ``lang`` are not learned. Their features, 16 KB a row, go to the
    driver. None without usable rows.
    """
    taken = sampled(examples, per_language, max_languages)

    def make():
        return lambda text, lang: [(lang, features(text).tobytes())] if LETTER.search(text) else []

    rows = sorted(map(tuple, map_rows(taken.select("text", "lang"), make, "lang string, features binary").collect()))
    if not rows:
        return None
    return Hierarchy(np.stack([np.frombuffer(bytes(f), np.float32) for _, f in rows]), [lang for lang, _ in rows])


def identify(docs: DataFrame, model: Hierarchy | None, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds the predicted language and a score from 0 to 1 to every row, judging its whole text.

    A null text, one without a letter, or a model that learned nothing gives ``und`` and score 0.
    Rows, repeated ones too, are judged one by one; columns called like the new ones are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 16 KB for each pair of languages in a family
    judged = unused(docs, "_judged")
    each = [F.col(f"{judged}.{c}") for c in ("lang_pred", "score")]
    return docs.withColumn(judged, _judge(shared)(F.col(text))).withColumns(dict(zip(names, each))).drop(judged)


def _judge(shared):
    def judge(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        found = [
            model.predict(features(t)) if model is not None and t is not None and LETTER.search(t) else (UNKNOWN, 0.0)
            for t in texts
        ]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return F.pandas_udf(judge, "lang_pred string, score double")
