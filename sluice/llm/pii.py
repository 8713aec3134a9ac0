"""Personal data: patterns, and terms that give protected entities away. DataFrame functions only.

Patterns find the protected entities: e-mail and IP addresses, card and phone numbers, and what several of
them share: a mail domain, the network of an IP address, the issuer of a card, the block of a phone number.
How strongly a term t reveals an entity c is what remains unknown of the entity to a reader who meets the term,

    IC(c) - PMI(c; t) = -log p(c | t),

estimated from the corpus. A term whose texts leave at most :data:`RESIDUAL` nats discloses the entity;
it is a span of kind ``term`` wherever it stands, in texts without the entity too. The bar is the same
for every entity and size of corpus, and must be met by a lower confidence bound, not by the estimate:

- p(c | t) is the share of the rows with the term that have the entity too, all rows counted, copies
  included. Its confidence comes from the number of distinct texts with both, for copies are no
  evidence, and near copies little: the smallest hashes of :data:`SHINGLE` words agree in two texts as often
  as the texts are alike, and the effective number is the inverse chance of that. One text is never
  enough.
- The meetings must be more than chance would give among all pairs of an entity and a term that have two
  texts: by the Chernoff bound, less than :data:`CHANCE` of one such pair is expected in the whole
  corpus if terms fell on texts at random.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import documents, stored, unused, with_keys

KINDS = ["email", "ip", "card", "phone", "term"]
#: The same matches as the plain patterns, in linear time: runs are entered at their start (or where
#: the last match ended) and never given back; card runs of other lengths fail anyway.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_PARTS = r"^(0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(\.|$)){4}$"
TERM = r"[\p{L}\p{N}]+"
#: A term in a text whose spans are blanked; with a mark in it, a span touches it.
MARKED_TERM = r"[\p{L}\p{N}\x01]+"
#: Nats that a reader of the term may at most lack; 1.1: the guess is right in one of three cases.
RESIDUAL = 1.1
#: Deviations of the one-sided 95 % confidence bound, and the pairs that chance may give in a corpus.
SURE = 1.645
CHANCE = 0.05
#: Consecutive words whose least hashes are a text's signatures, and what hashes are flipped by for each of them.
SHINGLE = 5
FLIPS = [0x243F6A8885A308D3, 0x13198A2E03707344, 0x24093822299F31D0, 0x082EFA98EC4E6C89]
_BLOCK = 256
#: Hashes of terms in the filter before the join with disclosing terms; bounds its broadcast.
_HASHES = 1 << 20
_SPAN = "struct<start: long, kind: int, end: long, value: string>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(IP_PARTS)
    if kind == "card":
        return F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda total, x: total + x)


def _located(rows: DataFrame, text: str, pattern: str, test: Column, out: str) -> DataFrame:
    """Adds all matches in a text as array<struct<start, end, value>>, code points, in order.

    Matches and the texts between them give the places, by sums over blocks and within a block.
    """
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_hits", F.when(test, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    rows = rows.withColumn("_gaps", F.when(F.size("_hits") > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    lengths = F.zip_with("_hits", F.slice("_gaps", 1, F.size("_hits")), lambda h, g: (F.length(h) + F.length(g)).cast("long"))
    rows = rows.withColumn("_each", lengths)
    blocks = F.when(F.size("_each") > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size("_each") - 1) / _BLOCK).cast("int")), lambda b: _sum(F.slice("_each", b * _BLOCK + 1, F.lit(_BLOCK)))))
    rows = rows.withColumn("_blocks", F.coalesce(blocks, F.array().cast("array<long>")))

    def place(hit: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        before = _sum(F.slice("_blocks", 1, block)) + _sum(F.slice("_each", block * _BLOCK + 1, i - block * _BLOCK))
        start = before + F.length(F.element_at("_gaps", i + 1))
        return F.struct(start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("value"))

    return rows.withColumn(out, F.transform("_hits", place)).drop("_hits", "_gaps", "_each", "_blocks")


def _of_kind(number: int, kind: str) -> Column:
    """The valid ones of a kind's matches as spans."""
    span = lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), m["value"].alias("value"))
    return F.transform(F.filter(f"_{kind}", lambda m: _valid(kind, m["value"])), span)


def base_spans(rows: DataFrame, text: str) -> DataFrame:
    """Adds spans: array<struct<start, kind, end, value>> of the patterns, by start and kind."""
    has_digit = F.col(text).rlike("[0-9]")
    rows = rows.withColumn("_digit", has_digit)
    tests = {"email": F.contains(text, F.lit("@")), "ip": F.col("_digit"), "card": F.col("_digit"), "phone": F.contains(text, F.lit("+")) & F.col("_digit")}
    found = []
    for number, kind in enumerate(KINDS[:4]):
        rows = _located(rows, text, PATTERNS[kind], tests[kind], f"_{kind}")
        found.append(_of_kind(number, kind))
    return rows.withColumn("spans", F.sort_array(F.concat(*found))).drop("_digit", *(f"_{k}" for k in KINDS[:4]))


def entities(span: Column) -> Column:
    """What a span names: its value and what it shares with others, after the kind's number.

    Shared are the domain of a mail address, the first three parts of an IP address, the first six digits
    of a card, and all but the last four of a phone number.
    """
    value, digits = F.lower(span["value"]), _digits(span["value"])
    named = lambda mark, x: F.concat(span["kind"].cast("string"), F.lit(mark), x)
    shared = (
        F.when(span["kind"] == 0, F.substring_index(value, "@", -1))
        .when(span["kind"] == 1, F.substring_index(value, ".", 3))
        .when(span["kind"] == 2, F.substring(digits, 1, 6))
        .otherwise(F.left(digits, F.length(digits) - 4))
    )
    return F.array(named(":", value), named("@", shared))


def _terms(text: Column) -> Column:
    """The distinct lower-cased terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def with_signatures(rows: DataFrame) -> DataFrame:
    """Adds signs, smallest hashes of a text's shingles, all its words being one if they are fewer."""
    words = F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), F.lower)
    last = F.greatest(F.size("words") - SHINGLE, F.lit(0))
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice("words", i + 1, F.lit(SHINGLE))))
    signs = F.array(*(F.array_min(F.transform("hashes", lambda h, c=c: h.bitwiseXOR(F.lit(c)))) for c in FLIPS))
    # Words and hashes are columns of their own: within a lambda they would be found anew for each shingle.
    return rows.withColumn("words", words).withColumn("hashes", hashes).withColumn("signs", signs).drop("words", "hashes")


def _blanked(text: Column, covered: Column) -> Column:
    """The text with a mark for every code point in the united spans ``covered``, all else in its place."""
    clean = F.translate(text, "\x01", " ")
    begin = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.try_element_at(covered, i)["end"])
    piece = lambda s, i: F.concat(
        F.substring(clean, begin(i).cast("int") + 1, (s["start"] - begin(i)).cast("int")),
        F.repeat(F.lit("\x01"), (s["end"] - s["start"]).cast("int")),
    )
    tail = F.substring(clean, F.try_element_at(covered, F.lit(-1))["end"].cast("int") + 1, F.length(text))
    return F.when(F.size(covered) > 0, F.concat(F.array_join(F.transform(covered, piece), ""), tail)).otherwise(clean)


def _outside(texts: DataFrame) -> DataFrame:
    """(s1, s2, term) of (s1, s2, spans, text): the distinct terms of a whole text that no span touches."""
    rows = texts.withColumn("covered", _united(F.col("spans")))
    rows = rows.select("s1", "s2", _blanked(F.col("text"), F.col("covered")).alias("text"))
    found = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(MARKED_TERM), F.lit(0)), F.lower))
    return rows.select("s1", "s2", F.explode(F.filter(found, lambda w: ~F.contains(w, F.lit("\x01")))).alias("term"))


def assured(both: Column, term: Column, texts: Column) -> Column:
    """The lower confidence bound (Wilson's) of p(c | t): ``both`` of ``term`` rows, ``texts`` effective texts with both."""
    share, trials = both / term, texts * term / both
    spread = F.sqrt(share * (1 - share) / trials + SURE**2 / (4 * trials * trials))
    return (share + SURE**2 / (2 * trials) - SURE * spread) / (1 + SURE**2 / trials)


def surprise(both: Column, term: Column, texts: Column, chance: Column) -> Column:
    """Nats against as many meetings by chance: trials times the divergence of their share from ``chance``."""
    share, trials = both / term, texts * term / both
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - chance))).otherwise(0.0)
    return F.when(share > chance, trials * (share * F.log(share / chance) + rest)).otherwise(0.0)


def revealing(docs: DataFrame, texts: DataFrame, residual: float = RESIDUAL) -> DataFrame:
    """(s1, s2, term) for each text and each term in it that discloses an entity of it.

    ``texts`` are the distinct ones with entities, (s1, s2, signs, copies, spans, text). Counts are over
    all of ``docs``. Entities of the same texts are one class, so that a list of many, repeated as a
    whole, makes no pairs of each with each word. Entities of one distinct text and terms too common for
    any entity of theirs (n_term over n_entity / p) cannot pass and are left out before pairs are counted.
    """
    n = max(1, docs.count())
    least = math.exp(-residual)
    each = F.explode(F.array_distinct(F.flatten(F.transform("spans", entities))))
    named = stored(texts.select("s1", "s2", "copies", each.alias("entity")), "entities")
    place = F.xxhash64("s1", "s2").cast("decimal(38,0)")
    counted = named.groupBy("entity").agg(
        F.count("*").alias("n_texts"), F.sum("copies").alias("n_entity"), F.sum(place).alias("places"), F.bit_xor(F.xxhash64("s2", "s1")).alias("mix")
    )
    counted = counted.filter((F.col("n_texts") > 1) & (F.col("n_entity") < n))
    kind = ["n_texts", "n_entity", "places", "mix"]
    classes = counted.groupBy(*kind).agg(F.min("entity").alias("class"))
    members = named.join(counted.join(classes, kind).filter("entity = class").select("entity", "n_entity"), "entity")
    members = stored(members, "counted-entities")
    if members.isEmpty():  # then no pair can pass
        return texts.select("s1", "s2", F.lit("").alias("term")).limit(0)
    some = texts.join(members.select("s1", "s2").distinct().hint("merge"), ["s1", "s2"], "left_semi")
    known = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    known = stored(known.filter("n_term > 1"), "terms")
    words = _outside(some).join(known.hint("merge"), "term")
    met = members.join(words.hint("merge"), ["s1", "s2"]).filter(F.col("n_term") * least <= F.col("n_entity"))
    near = stored(met, "near")
    pair = ["entity", "term", "n_entity", "n_term"]
    pairs = near.groupBy(*pair).agg(F.sum("copies").alias("n_both"), F.count("*").alias("n_texts")).filter("n_texts > 1")
    pairs = stored(pairs, "pairs")
    # How alike a pair's texts are: the share of two of them, drawn at random, that have a signature in common.
    each = near.join(pairs.select("entity", "term").hint("merge"), ["entity", "term"], "left_semi").select("s1", "s2", "entity", "term")
    each = each.join(texts.select("s1", "s2", F.posexplode("signs").alias("flip", "sign")).hint("merge"), ["s1", "s2"])
    kin = each.groupBy("entity", "term", "flip", "sign").agg(F.count("*").cast("double").alias("k"))
    alike = kin.groupBy("entity", "term").agg((F.sum(F.col("k") ** 2) / len(FLIPS)).alias("same"))
    pairs = pairs.join(alike.hint("merge"), ["entity", "term"]).withColumn("n_apart", F.col("n_texts").cast("double") ** 2 / F.col("same"))
    tried = max(1, known.count() * members.select("entity").distinct().count())
    counts = [F.col(c).cast("double") for c in ("n_both", "n_term", "n_apart")]
    passed = pairs.filter(assured(*counts) >= least)
    passed = passed.filter(surprise(*counts, F.col("n_entity") / n) >= math.log(tried / CHANCE))
    return near.select("s1", "s2", "entity", "term").join(passed.select("entity", "term"), ["entity", "term"], "left_semi").select("s1", "s2", "term").distinct()


def _everywhere(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(k1, k2, term) of all rows that hold one of the terms, in a text with the entity or not."""
    slot = lambda: F.pmod(F.xxhash64("term"), F.lit(_HASHES)).cast("int")
    slots = F.broadcast(terms.select(slot().alias("slot")).distinct())  # at most _HASHES numbers
    held = rows.select("k1", "k2", F.explode(_terms(F.col("text"))).alias("term")).withColumn("slot", slot())
    return held.join(slots, "slot", "left_semi").select("k1", "k2", "term").join(terms.hint("merge"), "term", "left_semi")


def _marked(rows: DataFrame) -> DataFrame:
    """(k1, k2, terms) of (k1, k2, text, spans, found): the places of the words in ``found`` outside of spans.

    Lengths of words and of what lies between them give the places, by sums over blocks and within a
    block; only for words that are met.
    """
    rows = rows.withColumn("covered", _united(F.col("spans")))
    rows = rows.select("k1", "k2", "found", _blanked(F.col("text"), F.col("covered")).alias("text"))
    hit, gap = F.regexp_extract_all("text", F.lit(MARKED_TERM), F.lit(0)), F.split("text", MARKED_TERM, -1)
    each = F.zip_with(hit, F.slice(gap, 1, F.size(hit)), lambda h, g: F.struct(F.lower(h).alias("term"), F.length(h).alias("size"), (F.length(h) + F.length(g)).cast("long").alias("step")))
    rows = rows.select("k1", "k2", "found", each.alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(w["term"].alias("term"), w["size"].alias("size"), i.alias("at")))
    steps = F.col("words.step")
    numbers = F.sequence(F.lit(0), F.floor(F.size(steps) / _BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: _sum(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))))
    met = F.filter(placed, lambda w: F.array_contains("found", w["term"]))
    rows = rows.select("k1", "k2", steps.alias("steps"), blocks.alias("blocks"), met.alias("met"))

    def span(w: Column) -> Column:
        block = F.floor(w["at"] / _BLOCK).cast("int")
        end = _sum(F.slice("blocks", 1, block)) + _sum(F.slice("steps", block * _BLOCK + 1, w["at"] - block * _BLOCK + 1))
        return F.struct((end - w["size"]).alias("start"), F.lit(KINDS.index("term")).alias("kind"), end.alias("end"), w["term"].alias("value"))

    return rows.select("k1", "k2", F.transform("met", span).cast(f"array<{_SPAN}>").alias("terms"))


def find(docs: DataFrame, residual: float = RESIDUAL, everywhere: bool = False) -> DataFrame:
    """(doc_id, k1, k2, spans, terms) for every row: pattern matches and disclosing terms.

    spans and terms are array<struct<start, kind, end, value>> with kind a place in :data:`KINDS`,
    places in code points and ends exclusive. Terms are all mentions in whole texts, however long: of the
    terms that disclose an entity of the same text or, if ``everywhere``, any entity of the corpus. A
    null text is empty. Repeated rows have equal results. Other columns are not looked at.
    """
    rows = with_keys(documents(docs), ("k1", "k2"))
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    some = F.size("spans") > 0
    base = base_spans(rows, "text").withColumns({"s1": F.xxhash64("text"), "s2": F.xxhash64(F.length("text"), "text")})
    base = stored(base.select("doc_id", "k1", "k2", "s1", "s2", "spans", F.when(some, F.col("text")).alias("text")), "spans")
    none = F.array().cast(f"array<{_SPAN}>")
    same = base.filter(some).groupBy("s1", "s2")
    texts = same.agg(F.count("*").alias("copies"), F.first("spans").alias("spans"), F.first("text").alias("text"))
    texts = stored(with_signatures(texts), "texts")
    pairs = stored(revealing(rows, texts, residual), "revealing")
    if pairs.isEmpty():
        return base.select("doc_id", "k1", "k2", "spans", none.alias("terms"))
    if everywhere:
        hits = _everywhere(rows, stored(pairs.select("term").distinct(), "terms"))
    else:
        hits = base.filter(some).select("k1", "k2", "s1", "s2").join(pairs.hint("merge"), ["s1", "s2"]).select("k1", "k2", "term")
    hits = stored(hits.groupBy("k1", "k2").agg(F.collect_set("term").alias("found")), "hits")
    # Only rows with a term need their text again; each is looked through once, repeated or not.
    held = rows.select("k1", "k2", "text").join(hits.hint("merge"), ["k1", "k2"])
    spans = base.filter(some).select("k1", "k2", "spans").dropDuplicates(["k1", "k2"])
    held = held.dropDuplicates(["k1", "k2"]).join(spans.hint("merge"), ["k1", "k2"], "left").withColumn("spans", F.coalesce("spans", none))
    terms = stored(_marked(held), "term-spans")
    joined = base.select("doc_id", "k1", "k2", "spans").join(terms.hint("merge"), ["k1", "k2"], "left")
    return joined.withColumn("terms", F.coalesce("terms", none))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))))


def _united(spans: Column) -> Column:
    """Sorted spans, those that overlap joined under the kind of the first."""

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        here = F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        overlaps = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"])
        return F.when(overlaps, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(here)))

    return F.aggregate(F.sort_array(spans), F.array().cast("array<struct<start: long, kind: int, end: long>>"), add)


def sanitised(docs: DataFrame, **thresholds) -> DataFrame:
    """The rows of ``docs``, all columns as they are but the text, in which every span is generalised.

    An entity becomes its kind in brackets, ``[EMAIL]``; a disclosing term becomes ``[TERM]``, or
    ``[NUMBER]`` if it is one. Spans that overlap become one, of the first one's kind. Texts without
    spans, null ones too, stay as they are. Columns may have any names.
    """
    text = "text"
    k1, k2, spans = (unused(docs, name) for name in ("_k1", "_k2", "_spans"))
    found = find(docs, everywhere=True, **thresholds).filter(F.size("spans") + F.size("terms") > 0)
    numbered = F.transform("terms", lambda s: F.struct(s["start"], F.when(s["value"].rlike("^[0-9]+$"), len(KINDS)).otherwise(s["kind"]).alias("kind"), s["end"], s["value"]).cast(_SPAN))
    masks = found.dropDuplicates(["k1", "k2"]).select(F.col("k1").alias(k1), F.col("k2").alias(k2), _united(F.concat("spans", numbered)).alias(spans))
    # Merged at every size: the masks grow with the documents.
    rows = with_keys(docs, (k1, k2)).join(stored(masks, "masks").hint("merge"), [k1, k2], "left")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in [*KINDS, "number"]))
    begin = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.try_element_at(F.col(spans), i)["end"])
    piece = lambda s, i: F.concat(F.substring(text, begin(i).cast("int") + 1, (s["start"] - begin(i)).cast("int")), F.element_at(names, s["kind"] + 1))
    tail = F.substring(text, F.element_at(spans, -1)["end"].cast("int") + 1, F.length(text))
    masked = F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(spans, piece), ""), tail)).otherwise(F.col(text))
    return rows.withColumn(text, masked).select(*(F.col(f"`{c}`") for c in docs.columns))
