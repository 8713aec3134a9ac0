"""Trained operators: held-out accuracy, defined results for odd rows, what the penalty is for."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import language, toxicity
from sluice.llm.common import crc32_of_id

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_languages_of_held_out_documents(docs):
    held = crc32_of_id(F.col("doc_id")) % 4 == 2
    model = language.fit(docs.filter(~held).select("text", "lang"))
    found = language.identify(docs.filter(held), model)
    assert found.columns == [*docs.columns, "lang_pred", "score"]
    rows = found.collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd, none):
    model = language.fit(odd.select("text", "lang"))
    rows = language.identify(odd, model, names=("l", "s")).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["l"] == "und") == (r["doc_id"] in (2, 3, 4, 5) or r["text"] is None)
        assert r["score"] in ("x", "y", "z", "", None)  # the clashing column stays
    assert language.fit(none.select("text", "lang")) is None
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}
    assert language.identify(none, model).collect() == []


def test_hierarchy_of_many_families():
    r = np.random.default_rng(3)
    langs = ["de", "en", "fr", "es", "ru", "xx"]
    centres = {x: r.normal(size=40) for x in langs}
    draw = lambda x: (centres[x] + 0.3 * r.normal(size=40)).astype(np.float32)
    labels = [x for x in langs for _ in range(30)]
    model = language.Hierarchy(np.stack([draw(x) for x in labels]), labels)
    assert sum(model.predict(draw(x))[0] == x for x in langs for _ in range(20)) >= 115
    one = language.Hierarchy(np.stack([draw("de")] * 3), ["de"] * 3)
    assert one.predict(draw("fr")) == ("de", 1.0)


@pytest.fixture(scope="module")
def insults(spark):
    """Documents of which a third hold an insult; groups are named in all kinds, more in toxic ones."""
    r = random.Random(7)
    groups, bad = ["muslims", "jews", "women", "gay", "immigrants"], ["scumlord", "vermint", "filthax", "moronic"]
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        lines = [[f"w{r.randrange(400)}" for _ in range(12)] for _ in range(r.randrange(1, 5))]
        if toxic:
            r.choice(lines).insert(3, r.choice(bad))
        if r.random() < (0.8 if toxic else 0.1):
            r.choice(lines).insert(5, r.choice(groups))
        rows.append((i, ". ".join(" ".join(x) for x in lines), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_of_held_out_documents(insults):
    weights = toxicity.fit(insults, insults.filter("doc_id % 5 > 0"))
    rows = toxicity.score(insults.filter("doc_id % 5 = 0"), weights).collect()
    assert sum((r["score"] >= 0.7) == bool(r["toxic"]) for r in rows) >= 0.95 * len(rows)


def test_a_groups_name_carries_little_weight(spark, insults):
    weights = toxicity.fit(insults, insults)
    cases = [("the jews and muslims next door are nice",), ("the neighbours next door are nice",), ("immigrants are vermint",)]
    neutral, plain, insult = (r["score"] for r in toxicity.score(spark.createDataFrame(cases, "text string").coalesce(1), weights).collect())
    assert neutral < 0.7 < insult and abs(neutral - plain) < 0.35
    examples = [(1, [1, 5], [1, 6]), (0, [2], None), (1, [1, 6], [1, 5]), (0, [3, 4], None), (1, [5], [6])]
    free, held = (toxicity.regression(examples, counterfactual=c) for c in (0.0, 10.0))
    assert abs(held[5] - held[6]) < 0.2 * abs(free[5] - free[6])


def test_toxicity_of_odd_rows(spark, odd, none, insults):
    weights = toxicity.fit(odd, none.selectExpr("doc_id", "start AS toxic"))
    rows = toxicity.score(odd, weights).collect()
    assert len(rows) == odd.count() and {r["score"] for r in rows} == {0.5}
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    weights = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, weights).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(none, weights).collect() == []


def test_a_phrase_counts_wherever_a_long_sentence_is_cut(insults):
    """Windows overlap by half, so where an insult lies in a text without stops makes no difference."""
    weights = toxicity.fit(insults, insults)
    spark = insults.sparkSession
    plain = [f"w{i % 50}" for i in range(200)]
    rows = [(at, " ".join([*plain[:at], "you", "are", "moronic", "vermint", *plain[at:]])) for at in range(0, 200, 7)]
    scores = [r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), weights).collect()]
    assert min(scores) >= 0.7
    words = [str(i) for i in range(100)]
    cut = toxicity.sentences(" ".join(words) + ". a b")
    assert cut[-1] == ["a", "b"] and all(len(s) <= 32 for s in cut)
    assert all(any(words[i : i + 16] == s[j : j + 16] for s in cut for j in range(len(s) - 15)) for i in range(85))
    assert sorted({w for s in cut[:-1] for w in s}) == sorted(words)


@pytest.mark.parametrize("share", [0.03, 0.5, 0.97])
def test_samples_are_the_smallest_hashes_of_a_class(spark, share):
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") < 4000 * share).cast("int").alias("toxic"))
    docs = labels.select("doc_id", F.concat(F.lit("t"), "doc_id").alias("text"))
    found = {(r["toxic"], r["text"]) for r in toxicity._sample(docs, labels, 100).collect()}
    hashed = [tuple(r) for r in labels.select("toxic", F.xxhash64("doc_id"), F.concat(F.lit("t"), "doc_id")).collect()]
    expected = {(c, t) for c in (0, 1) for _, _, t in sorted(x for x in hashed if x[0] == c)[:100]}
    assert found == expected


def test_only_the_commonest_languages_are_learned(spark):
    rows = [(f"{lang} text {i} of words", lang) for lang, n in (("de", 30), ("en", 20), ("zz", 20), ("yy", 3)) for i in range(n)] * 2
    examples = spark.createDataFrame(rows, "text string, lang string")
    assert language.fit(examples, per_language=10, max_languages=3).langs == ["de", "en", "zz"]
    found = language.sampled(examples, 10, 3)
    assert {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()} == {"de": 10, "en": 10, "zz": 10}


def test_columns_of_any_name_survive_identification(spark):
    docs = spark.createDataFrame([("words here", "en", 1, 2)], "text string, lang string, _judged int, __judged int")
    row = language.identify(docs, language.fit(docs)).first()
    assert row["_judged"] == 1 and row["__judged"] == 2 and row["lang_pred"] == "en"
