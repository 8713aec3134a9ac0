"""The pipeline: stages against brute force, odd rows, and the driver's contract."""

import re

import pytest

import __spark_entry__ as driver
import corpus_pipeline as cp
from compare import connect, differences
from sluice.llm.oracle import ORACLE
from sluice.llm.queries import QUERIES
from test_near_duplicates import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.cache()]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_each_stage_keeps_what_it_should(spark, stages):
    docs, spoken, single, clean, masked, packed = [*map(by_id, stages[:5]), stages[5]]
    assert spoken == {i: t for i, t in docs.items() if t and re.search(r"[^\W\d_]", t)}
    kept = {i for i, _, c in brute(sorted(spoken.items()), 5, 0.8) if i == c}
    assert set(single) == kept
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    runs = {tuple(w[i : i + min(10, len(w))]) for w in items for i in range(max(1, len(w) - 9))}
    dirty = {i for i, t in single.items() for w in [words(t)] for n in {len(r) for r in runs} if any(tuple(w[k : k + n]) in runs for k in range(len(w) - n + 1))}
    assert set(clean) == set(single) - dirty
    assert set(masked) == set(clean)
    assert all("@" not in t or not re.search(r"[\w.+-]+@[\w-]+\.[\w-]+", t) for t in masked.values())
    assert {r["doc_id"] for r in packed.collect()} == set(masked)


def test_odd_rows_pass_every_stage(spark, odd, none):
    docs = odd
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() >= 3, name
    empty = none
    for name, stage in cp.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0, name


def test_registered():
    names = set(driver.queries())
    assert {"pipeline", *QUERIES} <= names and sorted(n[:3] for n in QUERIES) == sorted(f"op{i}_"[:3] for i in range(1, 14))
    assert set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None
