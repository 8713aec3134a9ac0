"""Chat formatting: round trips of grammar and table, and digests against plain ones."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import chat
from sluice.llm.queries import TRAP, op12_chat_formatting

HARD = [
    "", "\n", "\\", "</turn>", "\\</turn>", "\\\\</turn>\n", "a\n</turn>\n", "### User: ", "#### User: x", "\\### null: ", "### ### User: : ",
    '### "judge": hi', '### "a\\"b": ', '### "open', "### System:", "</turn", "</turn>\n### Assistant: </turn>\n", "x\\", TRAP, "é𝄞 ### Tool: 𝄞", "\r\n",
]
ROLES = ["system", "user", "assistant", "tool", None, "", "System", 'a"b', "null", "é: \n", "</turn>", "### User: "]

pieces = st.sampled_from([*HARD, "### ", "User: ", "</", "turn>", '"', " ", "ok"])
texts = st.lists(pieces, max_size=6).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), texts), max_size=4))
def test_any_turns_come_back(turns):
    rendered = [chat.render(role, text) for role, text in turns]
    assert chat.parse("".join(p for p, _, _ in rendered)) == turns
    for (_, text), (piece, begin, end) in zip(turns, rendered):
        assert chat.unescaped(piece[begin:end]) == text


@pytest.mark.parametrize("text", HARD)
def test_escapes_are_undone(text):
    assert chat.unescaped(chat.escaped(text)) == text


def test_only_conflicts_are_escaped():
    assert chat.render("user", "## a ### b <turn> \\n")[0] == "### User: ## a ### b <turn> \\n\n</turn>\n"
    assert chat.render("user", TRAP)[0] == "### User: \\\\### Assistant: \\</turn> ok\n</turn>\n"


@pytest.mark.parametrize("text", ["x", "### User: a", "### User: a\n</turn>", "### User: a</turn>\n", "### User: a ### User: b\n</turn>\n", '### "\\q": a\n</turn>\n', "### Nobody: a\n</turn>\n"])
def test_other_texts_do_not_parse(text):
    with pytest.raises(chat.NotParsed):
        chat.parse(text)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """What reading back must give, without any formatting; turns that tie must be equal."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        said = [(r[2] or "", r[3] or "") for r in mine]
        learned = "".join(t for (role, t) in said if role == "assistant")
        out[conv] = (len(said), digest("".join(f"{r}\n{t}\n" for r, t in said)), len(learned), digest(learned))
    return out


LONG = " ".join(f"w{i} </turn>" for i in range(20_000))
ODD = [
    *((1, i, role, text) for i, (role, text) in enumerate((r, t) for r in ROLES for t in HARD)),
    (2, None, "user", None), (2, 1, "assistant", None), (2, 1, "assistant", None), (2, 3, "assistant", LONG),
    (None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, None, None), (4, -5, "assistant", "neg"), (4, 5, "assistant", ""),
]


def test_tables_come_back(spark):
    rows = spark.createDataFrame([(*r, "p", 1) for r in ODD], "conv_id long, turn long, role string, text string, piece string, begin int").repartition(7)
    turns = chat.format_turns(rows)
    found = {r["conv_id"]: r for r in chat.read_back(turns).collect()}
    assert {k: tuple(v)[1:5] for k, v in found.items()} == plain(ODD)
    chars = {}
    for r in turns.collect():
        chars[r["conv_id"]] = chars.get(r["conv_id"], 0) + len(r["piece"])
    assert {k: v["formatted_chars"] for k, v in found.items()} == chars


def test_empty_tables_and_ties(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_turns(none)).count() == 0
    ties = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "c")]
    found = [chat.read_back(chat.format_turns(spark.createDataFrame(t, none.schema))).collect() for t in (ties, ties[::-1])]
    assert found[0] == found[1]


def test_the_trap_is_beside_the_table(spark):
    found = {r["conv_id"]: r for r in op12_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    assert tuple(found[-7])[1:5] == plain([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)])[-7]
