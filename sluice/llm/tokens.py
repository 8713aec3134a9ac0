"""Token ids of public tokenizers, and the exact histogram of encoded lengths."""

from __future__ import annotations

import json
import re
from array import array

import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm.common import Memo, documents, map_rows, stored

# A space beside another space or control character; elsewhere a space always begins a token.
_RUN = re.compile(r"[\s\x00-\x20\x7f-\xa0] | [\s\x00-\x20\x7f-\xa0]")
_LINES = re.compile(r"(?<=[!-~])\n(?=[!-~])")


# Fixed value: how byte-level BPE parts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that all Unicode versions class alike, and the same parts for texts of these alone.
_LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_PLAIN = re.compile(rf"[ -~\n\r\t\u00a1-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u00d7\u00f7{_LATIN}]*")
_PARTS = re.compile(PATTERN.replace(r"\s\p{L}\p{N}", rf"\s{_LATIN}0-9").replace(r"\p{L}", f"[{_LATIN}]").replace(r"\p{N}", "[0-9]"))


def _by_ranks(path: str, special: set[str]) -> tiktoken.Encoding | None:
    """The same merges as ranks, for an encoder that costs less per call; None if they aren't in order of ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary = {token: i for token, i in model["vocab"].items() if token not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary.get(a + b) for a, b in pairs]
    if None in made or made != sorted(made) or len(made) + 256 != len(vocabulary):
        return None
    # Byte-level files write a visible Latin-1 byte as that character, the others from U+0100 on.
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(seen)))}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids, as little-endian 32-bit bytes, that a byte-level BPE tokenizer gives a text.

    Merging never crosses the parts of :data:`PATTERN`, so each distinct part is encoded once and
    remembered; the ids are those of the whole text. Texts of plain characters are cut by a pattern
    for these, and their parts take an encoder made from the file's own merges, which gives the same
    ids at a fraction of the cost of a call. Other texts are cut at single spaces and at newlines
    between visible characters, where a part always begins, and the tokenizer encodes what lies
    between. A text with the string of a special token goes to the tokenizer as it is.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = _by_ranks(path, set(self.special))
        self.part = Memo(self._quickly)
        self.bare = Memo(self._plainly)
        self.spaced = _Spaced(self)

    def _quickly(self, part: str) -> bytes:
        return array("I", self.quick.encode_ordinary(part)).tobytes()

    def _plainly(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def lines(self, text: str) -> bytes:
        """Ids of a part that holds newlines."""
        return self.bare["\n"].join(self.bare[x] for x in _LINES.split(text))

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._plainly(text)
        if self.quick and _PLAIN.fullmatch(text):
            return b"".join(map(self.part.__getitem__, _PARTS.findall(text)))
        parts = text.split(" ")
        if _RUN.search(text):
            parts = _glued(parts)
        first = self.lines(parts[0]) if "\n" in parts[0] else self.bare[parts[0]]
        return first + b"".join(map(self.spaced.__getitem__, parts[1:]))


class _Spaced(Memo):
    """Ids of parts that follow a space; those with newlines are put together and not kept."""

    def __init__(self, encoder: Encoder):
        super().__init__(lambda part: encoder._plainly(" " + part))
        self.encoder = encoder

    def __missing__(self, part):
        return self.encoder.lines(" " + part) if "\n" in part else super().__missing__(part)


def _glued(parts: list[str]) -> list[str]:
    """Joins parts again where the space between them has a neighbour that may belong to a run."""
    edge = lambda c: c.isspace() or c <= " " or "\x7f" <= c <= "\xa0"
    out = [[parts[0]]]
    for before, part in zip(parts, parts[1:]):
        if (before == "" and len(out) + len(out[0]) > 2) or (before and edge(before[-1])) or (part and edge(part[0])) or part == "":
            out[-1].append(part)
        else:
            out.append([part])
    return [" ".join(x) for x in out]


def lengths(docs: DataFrame, path: str) -> DataFrame:
    """(length, n_docs): the exact histogram of encoded lengths; a null text has length 0.

    Rows count as often as they occur, whole texts however long; other columns are not looked at. No
    rows give none.
    """

    def make():
        encode = Encoder(path)
        return lambda text: [(len(encode(text)) // 4 if text else 0,)]

    return map_rows(documents(docs).select("text"), make, "length long").groupBy("length").agg(F.count("*").alias("n_docs"))


#: Lengths that one task sums up; the blocks' own sums are one row for so many lengths.
BLOCK = 4096


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """(length, n_docs, docs_at_least, tokens_at_least, docs_share, tokens_truncated) for each length that occurs.

    docs_at_least and tokens_at_least count the documents of that length or more, and their tokens.
    tokens_truncated is what the corpus holds if each document is cut to that length, docs_share
    the share of documents no longer than it (so the q-quantile is the first length where it
    reaches q). An empty histogram gives no rows.
    """
    rows = stored(histogram, "lengths").withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("n_docs")
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    total = rows.agg(F.sum("n_docs").alias("all_docs"), F.sum(tokens).alias("all_tokens"))
    blocks = blocks.select("block", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("d", "t")))
    within = Window.partitionBy("block").orderBy(F.col("length").desc())
    out = rows.join(blocks, "block").join(F.broadcast(total))  # one row
    out = out.withColumn("docs_at_least", F.col("d_above") + F.sum("n_docs").over(within))
    out = out.withColumn("tokens_at_least", F.col("t_above") + F.sum(tokens).over(within))
    return out.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (1 - (F.col("docs_at_least") - F.col("n_docs")) / F.col("all_docs")).alias("docs_share"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("tokens_truncated"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_cut, tokens_truncated) for any context limits, from suffix sums.

    docs_cut counts the documents longer than the limit.
    """
    wanted = sums.sparkSession.createDataFrame([(x,) for x in sorted(set(limits))], "context_limit long")
    longer = F.when(F.col("length") > F.col("context_limit"), F.col("n_docs")).otherwise(0)
    kept = F.least("length", "context_limit") * F.col("n_docs")
    met = sums.join(F.broadcast(wanted))  # the caller's few limits
    return met.groupBy("context_limit").agg(F.sum(longer).alias("docs_cut"), F.sum(kept).alias("tokens_truncated"))
