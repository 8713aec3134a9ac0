"""Personal data against Python's own patterns and a plain count of pairs."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import pii


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    text = text or ""
    count = lambda m: sum(c in "0123456789" for c in m)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= count(m) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= count(m) <= 15),
    ]
    out = []
    for kind, (pattern, valid) in enumerate(kinds):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if valid(m[0])]
    return sorted(out)


CASES = [
    "a@b.co", "x a.b+c@d-e.f.g, y", "a@b.c_d@e.f", "aa@bb@cc.dd", "a@b", "@b.c", "a@b..c", "é ü a@b.cé", "a@b.c." + "x" * 30 + "@q.r",
    "1.2.3.4", "1.2.3.4.5", "256.1.1.1 0255.1.1.001", "12.3.4", "999999999999999999999.1.1.1", "1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "x4111  1111 1111 1111", "123456789012345678901234567890", "49 92 71 69 75 97",
    "+1 (212) 555-0199", "+1234567", "+1 2 3 4 5 6 7 8 9 0 ) x", "++49 30 123456", "+4930123456.", "+1 4111 1111 1111 1111", "", None, " ", "日本 +1 (212) 555-0199 語",
    "ab" * 3000, "7" * 5000, "1 " * 3000, "+" * 500, "a." * 1500 + "@", "1." * 2000,
]


def random_text(r):
    return "".join(r.choice(["a", "b.", "@", "1", "23", ".", "-", " ", "+", "(", "4111111111111111", "1.2.3.4", "x@y.z", "é", "\n", "_"]) for _ in range(r.randrange(60)))


@pytest.fixture(scope="module")
def found(spark):
    r = random.Random(11)
    rows = [(i, t) for i, t in enumerate(CASES + [random_text(r) for _ in range(1500)])]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


def test_base_spans(found):
    docs, texts = found
    for row in pii.find(docs).collect():
        assert [(s["start"], s["kind"], s["end"]) for s in row["spans"]] == brute(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_listed(spark):
    docs = spark.createDataFrame([(1, "é a@b.co 1.2.3.4"), (2, "none")], "doc_id long, text string")
    lists = {r[0]: r[1] for r in pii.find(docs).select("doc_id", pii.listed(F.col("spans"))).collect()}
    assert lists == {1: "email:2:8,ip:9:16", 2: ""}
    assert hashlib.sha256(b"").hexdigest() == docs.select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]


@pytest.fixture(scope="module")
def told(spark):
    """``zorro`` comes with one address and hardly elsewhere; ``the`` is everywhere; copies are no evidence."""
    rows = [(i, f"the note {i} by zorro at don{i % 1}@villa.mx in the hall") for i in range(4)]
    rows += [(10 + i, f"the day {i} and the night") for i in range(80)]
    rows += [(100 + i, "the rumour by lonely at solo@one.mx the end") for i in range(6)]
    rows += [(200, "zorro was not seen here"), (300, "write to don0@villa.mx, zorro!")]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


def test_terms_that_disclose(told):
    docs, texts = told
    terms = {r["doc_id"]: [(t["value"], texts[r["doc_id"]][t["start"] : t["end"]]) for t in r["terms"]] for r in pii.find(docs).collect()}
    flagged = {v for t in terms.values() for v, _ in t}
    assert "zorro" in flagged and "the" not in flagged and "lonely" not in flagged
    assert all(v == raw.lower() for t in terms.values() for v, raw in t)
    assert terms[200] == [] and ("zorro", "zorro") in terms[300]


def plain_signatures(text):
    words = [m[0].lower() for m in re.finditer(r"[^\W_]+", text)]
    each = []
    for i in range(max(len(words) - 5, 0) + 1):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        each.append(h - (1 << 64) if h >> 63 else h)
    return [min(h ^ flip for h in each) for flip in pii.FLIPS]


def plain_terms(rows):
    """The terms that disclose an entity, by plain counts over all rows and distinct texts."""
    import math

    near: dict = {}
    n_entity: dict = {}
    n_term: dict = {}
    for text in rows:
        spans = brute(text)
        named = set()
        for start, kind, end in spans:
            value = text[start:end].lower()
            digits = re.sub("[^0-9]", "", value)
            part = [value.rpartition("@")[2], ".".join(value.split(".")[:3]), digits[:6], digits[:-4]][kind]
            named |= {f"{kind}:{value}", f"{kind}@{part}"}
        outside = {m[0].lower() for m in re.finditer(r"[^\W_]+", text) if not any(m.start() < e and m.end() > s for s, _, e in spans)}
        for e in named:
            n_entity.setdefault(e, []).append(text)
            for t in outside:
                near.setdefault((e, t), []).append(text)
        for t in {m[0].lower() for m in re.finditer(r"[^\W_]+", text)}:
            n_term[t] = n_term.get(t, 0) + 1
    least = math.exp(-1.1)
    classes = {frozenset(v): min(e for e in n_entity if set(n_entity[e]) == set(v)) for v in n_entity.values() if len(set(v)) > 1}
    tried = len(classes) * sum(n > 1 for n in n_term.values())
    pairs = {k: v for k, v in near.items() if k[0] in classes.values() and len(set(v)) > 1 and n_term[k[1]] * least <= len(n_entity[k[0]])}
    out = set()
    for (e, t), texts in pairs.items():
        kin = Counter((i, x) for text in set(texts) for i, x in enumerate(plain_signatures(text)))
        p, d = len(texts) / n_term[t], len(set(texts)) ** 2 / (sum(n * n for n in kin.values()) / 4)
        m, chance, z = d / p, len(n_entity[e]) / len(rows), 1.645
        low = (p + z * z / 2 / m - z * math.sqrt(p * (1 - p) / m + z * z / 4 / m / m)) / (1 + z * z / m)
        odd = m * (p * math.log(p / chance) + ((1 - p) * math.log((1 - p) / (1 - chance)) if p < 1 else 0)) if p > chance else 0
        if low >= least and odd >= math.log(tried / 0.05):
            out.add((e, t))
    return out


def crowd(seed=7, n=300):
    """Texts with shared domains, lists of entities, copies and words that go with some of them."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = r.randrange(12)
        said = [r.choice(["the", "a", "note", "goes", "on", f"w{r.randrange(60)}"]) for _ in range(r.randrange(3, 12))]
        if k < 5:
            said += [f"guild{k}", f"m{r.randrange(3)}@house{k}.org"]
        if k == 5:
            said += ["+1 (212) 555-01" + str(r.randrange(10, 14)), "switchboard"]
        if k == 6:
            said += ["10.1.2." + str(r.randrange(3)), "rack", "4111 1111 1111 1111", "a@b.co,c@d.co,e@f.co"]
        if r.random() < 0.1:
            said.append(r.choice(["guild1", "rack", "switchboard"]))
        r.shuffle(said)
        rows += [" ".join(said)] * (r.choice([1, 1, 1, 1, 40]) if k < 8 else 1)
    return rows


def test_disclosing_terms_equal_plain_counts(spark):
    rows = crowd()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    expected = plain_terms(rows)
    terms = {t for _, t in expected}
    assert {"guild0", "rack"} <= terms and not {"the", "note"} & terms
    for everywhere in (True, False):
        for r in pii.find(docs, everywhere=everywhere).collect():
            text, spans = rows[r["doc_id"]], brute(rows[r["doc_id"]])
            named = set()
            for start, kind, end in spans:
                digits = re.sub("[^0-9]", "", text[start:end])
                part = [text[start:end].rpartition("@")[2], ".".join(text[start:end].split(".")[:3]), digits[:6], digits[:-4]][kind]
                named |= {f"{kind}:{text[start:end]}", f"{kind}@{part}"}
            mine = terms if everywhere else {t for e, t in expected if any(same_texts(rows, e, x) for x in named)}
            want = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\W_]+", text) if m[0] in mine and not any(m.start() < e and m.end() > s for s, _, e in spans)]
            assert [(t["start"], t["end"], t["value"]) for t in r["terms"]] == want, text


_HOLDERS: dict = {}


def same_texts(rows, one, other):
    """Whether two entities are in the same texts."""
    if not _HOLDERS:
        for text in set(rows):
            for start, kind, end in brute(text):
                digits = re.sub("[^0-9]", "", text[start:end])
                part = [text[start:end].rpartition("@")[2], ".".join(text[start:end].split(".")[:3]), digits[:6], digits[:-4]][kind]
                for e in (f"{kind}:{text[start:end]}", f"{kind}@{part}"):
                    _HOLDERS.setdefault(e, set()).add(text)
    return _HOLDERS[one] == _HOLDERS[other]


def test_near_copies_are_little_evidence(spark):
    """Many variants of one text make none of its words a term; as many independent texts do."""
    r = random.Random(9)
    first = [f"v{r.randrange(10**6)}" for _ in range(80)]
    rows = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(30))) for i in range(600)]
    for i in range(30):
        said = [w if r.random() > 0.01 else f"x{r.randrange(10**6)}" for w in first]
        rows.append((1000 + i, " ".join([*said, "mia@house.org"])))
    rows += [(2000 + i, " ".join([*(f"y{r.randrange(10**6)}" for _ in range(20)), "gwen +1 (212) 555-0199"])) for i in range(30)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "terms.value").collect()
    assert {w for x in found for w in x["value"]} == {"gwen"}


def test_words_of_one_text_disclose_nothing(spark):
    """Neither words seen once beside an entity nor a corpus of any size makes them terms."""
    r = random.Random(2)
    for n in (40, 1500):
        rows = [(i, " ".join(f"v{r.randrange(10**6)}" for _ in range(20)) + (f" u{i}@h{i}.org" if i % 9 == 0 else "")) for i in range(n)]
        found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), everywhere=True)
        assert found.filter("size(terms) > 0").count() == 0


def test_sanitised(told, odd, none):
    docs, _ = told
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    assert clean[300] == "write to [EMAIL], [TERM]!" and clean[10] == "the day 0 and the night"
    out = pii.sanitised(odd)
    assert out.columns == odd.columns
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect()) == sorted(
        (str(r["doc_id"]), (r["text"] or "").replace("a@b.co", "[EMAIL]")) for r in odd.collect()
    )
    assert pii.sanitised(none).collect() == [] and pii.find(none).collect() == []


def test_overlaps_are_masked_once(spark):
    docs = spark.createDataFrame([(1, "4111111111111111@x.yz and 10.0.0.1")], "doc_id long, text string")
    (row,) = pii.sanitised(docs).collect()
    assert row["text"] == "[EMAIL] and [IP]"


def test_columns_of_any_name_are_handed_on(spark):
    names = "doc_id long, text string, _k1 int, _k2 int, __k1 int, _spans int, spans int, k1 string, terms string"
    docs = spark.createDataFrame([(1, "to a@b.co", 1, 2, 3, 4, 5, "six", "seven"), (2, None, 1, 2, 3, 4, 5, "six", "seven")], names)
    assert sorted(map(tuple, pii.sanitised(docs).collect())) == [(1, "to [EMAIL]", 1, 2, 3, 4, 5, "six", "seven"), (2, None, 1, 2, 3, 4, 5, "six", "seven")]


def test_main_path_is_native(told):
    docs, _ = told
    for df in (pii.find(docs), pii.sanitised(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_an_entity_of_two_texts_gets_terms_and_one_of_one_does_not(spark):
    rows = [(i, f"filler number w{i} goes on") for i in range(200)]
    rows += [(500, "filler rarissima calls rare@one.mx on"), (501, "filler twofold calls +1 (212) 555-0199"), (502, "filler twofold goes to +1 (212) 555-0199")]
    rows += [(600 + i, f"filler guildhall writes to member{i}@guild.mx") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r["doc_id"]: {t["value"] for t in r["terms"]} for r in pii.find(docs).collect()}
    assert "rarissima" not in terms[500] and "twofold" in terms[501] & terms[502]  # one text is no statistic
    assert all("guildhall" in terms[600 + i] for i in range(4))  # each address is in one text, the domain in four
    assert not {"filler", "on", "goes"} & set().union(*terms.values())


def test_copies_do_not_hide_a_term(spark):
    rows = [(i, f"filler number w{i} goes on") for i in range(2000)]
    rows += [(5000 + i, "filler xylograph for solo@one.mx on") for i in range(30)] + [(1, "xylograph, solo@one.mx"), (2, "so solo@one.mx xylograph")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {r["doc_id"]: {t["value"] for t in r["terms"]} for r in pii.find(docs).collect()}
    assert all("xylograph" in terms[i] for i in (5000, 5029)) and not {"filler", "on"} & terms[5000]


def test_disclosing_terms_are_marked_in_all_whole_texts(spark):
    far = lambda i: " ".join(["filler", f"far{i}"] * 30)  # noqa: E731 - near copies would be no evidence
    rows = [(i, f"filler number w{i} goes on") for i in range(100)]
    rows += [(200 + i, f"Zorro {far(i)} writes from don@villa.mx {far(i)} so ZORRO, {i}") for i in range(4)] + [(300, "zorro was not seen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    terms = {r["doc_id"]: [texts[r["doc_id"]][t["start"] : t["end"]] for t in r["terms"]] for r in pii.find(docs, everywhere=True).collect()}
    assert [w for w in terms[200] if w.lower() == "zorro"] == ["Zorro", "ZORRO"] and terms[300] == ["zorro"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    assert all("zorro" not in clean[200 + i].lower() for i in range(4)) and clean[300] == "[TERM] was not seen"
