"""Repair of conversation structure: the cheapest edits that give every conversation well-formed roles.

Well-formed are no turns, or an optional system turn and then user and assistant turns in pairs. Each row
of a conversation is a symbol, its role's initial and its fault. An automaton of four states reads the
roles that come out; a symbol's edits (keep, rerole, delete, inserts before it) make a 4 x 4 matrix of
costs between states, and matrices join by min-plus products. Equal consecutive symbols are one run,
which a cost vector crosses by the binary powers of the symbol's matrix; powers are kept per task.
From the costs still to come at the ends of runs, choices are unrolled forward, halving each run on
the way. Each edit leads to one state only, so taking the ASCII-least edit that keeps the cost gives the
ASCII-least audit.

Texts take no part in this: rows of a few bytes find the audits, then each conversation's texts pass by
once, in order, and the audit is applied to them. A task holds the symbols and the audit of one conversation, a
byte a turn, and never its texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sluice.llm.common import stored

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
#: What an undeleted truncated row costs beside its edit.
TRUNCATED = 3
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

#: States: nothing yet, after system, after user, after assistant. What keeping a role leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Where the one role that an insertion or a new role can give leads to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The cost of inserts after the last row.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[float, ...]
Matrix = tuple[Vector, ...]
#: A role's initial, or ``?`` for other roles, and a fault: ``x`` must go, ``t`` is truncated, else ``-``.
Symbol = str


def symbol(initial: str, must_go: bool, truncated: bool) -> Symbol:
    if must_go:
        return "?x"
    return (initial if initial in ("s", "u", "a") else "?") + ("t" if truncated else "-")


@lru_cache(None)
def edits(row: Symbol, state: int) -> tuple[tuple[str, int, int], ...]:
    """(initial, cost, state after) of the edits that consume a row, ASCII order."""
    out = [("D", DELETE, state)]
    extra = TRUNCATED if row[1] == "t" else 0
    if row[1] != "x":
        if row[0] in STEP[state]:
            out.append(("K", KEEP + extra, STEP[state][row[0]]))
        out.append(("R", REROLE + extra, NEXT[state]))
    return tuple(out)


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + y for x, y in zip(row, column)) for column in zip(*b)) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


@lru_cache(None)
def power(row: Symbol, k: int) -> Matrix:
    """The costs between states of 2^k such rows, inserts before each of them included."""
    if k:
        return product(power(row, k - 1), power(row, k - 1))
    far = float("inf")
    one = [[far] * 4 for _ in range(4)]
    for state in range(4):
        at, paid = state, 0
        for _ in range(3):  # three states at most can be reached by inserts
            for _, cost, after in edits(row, at):
                one[state][after] = min(one[state][after], paid + cost)
            at, paid = NEXT[at], paid + INSERT
    return tuple(map(tuple, one))


def crossed(row: Symbol, length: int, to_come: Vector) -> Vector:
    """The costs still to come before a run, from those after it."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            to_come = applied(power(row, k), to_come)
    return to_come


def unrolled(row: Symbol, length: int, state: int, to_come: Vector, out: list[str]) -> int:
    """Appends the edits of a run; returns the state after it."""
    if length > 1:
        second = length // 2
        state = unrolled(row, length - second, state, crossed(row, second, to_come), out)
        return unrolled(row, second, state, to_come, out)
    here = applied(power(row, 0), to_come)
    while True:
        if DELETE + to_come[state] == here[state]:
            out.append("D")
            return state
        if INSERT + here[NEXT[state]] == here[state]:
            out.append("I")
            state = NEXT[state]
            continue
        initial, _, after = next(e for e in edits(row, state) if e[1] + to_come[e[2]] == here[state])
        out.append(initial)
        return after


@lru_cache(1 << 12)
def audit(runs: tuple[tuple[Symbol, int], ...]) -> tuple[int, str]:
    """Cost and edits of the cheapest repair of a conversation, given as runs of equal symbols."""
    to_come = [END]
    for row, length in reversed(runs):
        to_come.append(crossed(row, length, to_come[-1]))
    cost, state, out = int(to_come.pop()[START]), START, []
    for row, length in runs:
        state = unrolled(row, length, state, to_come.pop(), out)
    while END[state]:
        out.append("I")
        state = NEXT[state]
    return cost, "".join(out)


def apply_audit(edits_: str) -> Callable[[str | None, str | None], Iterator[tuple[str, str, str]]]:
    """A function that takes a conversation's rows in order, and (None, None) at the end, and gives (edit, role, text)."""
    at, state = 0, START

    def give(role, text):
        nonlocal at, state
        while edits_[at : at + 1] == "I":
            at, state = at + 1, NEXT[state]
            yield "I", ROLE[state], ""
        if role is None:
            return
        edit, at = edits_[at], at + 1
        if edit == "D":
            return
        state = STEP[state][role[:1]] if edit == "K" else NEXT[state]
        yield edit, role if edit == "K" else ROLE[state], text

    return give


# ---- Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and ``?`` from it, 3 repeats the row, 4
    makes its role user. Nulls count as a space: roles, texts, and ids and turns in the key.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    rows = conversations.filter(kind != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


def _plain(turns: DataFrame) -> DataFrame:
    """Ids, turns, roles and texts without nulls, and two hashes that tell a conversation's role and text."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", "role")})


def _ordered(rows: DataFrame, *first: str) -> DataFrame:
    order = ["conv_id", *first, "turn", "role", "h1", "h2"]
    return rows.repartition("conv_id").sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in order))


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _per_conversation(rows: DataFrame, make: Callable, schema: str, flush: int = 2048) -> DataFrame:
    """Streams ordered rows: ``make()`` gives a conversation's (take, end), both giving tuples after the id."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ends, out = None, None, []
        for batch in batches:
            for conv_id, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now != (conv_id,):
                    if ends:
                        out.extend((*now, *r) for r in ends())
                    now, (take, ends) = (conv_id,), make()
                out.extend((conv_id, *r) for r in take(*values))
                if len(out) >= flush:
                    yield _batches(out, arrow)
                    out = []
        if ends:
            out.extend((*now, *r) for r in ends())
        if out:
            yield _batches(out, arrow)

    return rows.mapInArrow(run, schema)


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, initial, blank, again, cut) without texts.

    ``again`` is true where an earlier turn has the same role and text; the first turn of each comes
    by a join, which runtime skew handling can split. Copies within a turn are left to the reader.
    """
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    short = rows.select(
        "conv_id", "turn", "role", "h1", "h2", F.substring("role", 1, 1).alias("initial"),
        (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut"),
    )
    short = stored(short, "turns")
    # A null turn is before all others.
    first = short.groupBy(F.col("conv_id").alias("of"), F.col("h1").alias("f1"), F.col("h2").alias("f2")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))
    met = short.join(first.hint("merge"), same)
    return met.withColumn("again", ~F.col("turn").eqNullSafe(F.col("first.turn"))).drop("of", "f1", "f2", "first")


def audits(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation.

    ``turns`` has conv_id, turn, role and text; ``conversations`` the conv_ids, whether they have
    turns or not, and an id that has turns is there in any case. See :func:`repaired` for the order
    of turns and odd rows. The first fault of a row counts: blank (without a visible character),
    duplicate (its role and text seen earlier), truncated (not ended by ``.``, ``!`` or ``?``).
    ``gaps`` counts the turn numbers that are missing between the first and the last, ``illegal`` the
    neighbours whose role initials are no legal pair. ``audit`` has the initials of the cheapest
    edits in order, the ASCII-least of equally cheap ones.
    """
    short = _symbols(_plain(turns))
    none = [F.lit(None).cast(short.schema[c].dataType).alias(c) for c in short.columns[1:]]
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select("conv_id", *none)
    rows = _ordered(short.unionByName(ids)).select("conv_id", "turn", "h1", "h2", "initial", "blank", "again", "cut")

    def make():
        runs: list[list] = []
        counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0)
        least = most = last = before = None

        def take(turn, h1, h2, initial, blank, again, cut):
            nonlocal least, most, last, before
            if h1 is None:  # the id alone
                return ()
            again = again or (turn, h1, h2) == before
            if turn is not None:
                counts["distinct"] += turn != most
                least, most = turn if least is None else least, turn
            fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
            if fault:
                counts[fault] += 1
            if last is not None and last + initial not in LEGAL:
                counts["illegal"] += 1
            last, before = initial, (turn, h1, h2)
            row = symbol(initial, blank or again, cut)
            if runs and runs[-1][0] == row:
                runs[-1][1] += 1
            else:
                runs.append([row, 1])
            return ()

        def end():
            gaps = 0 if least is None else most - least + 1 - counts["distinct"]
            cost, found = audit(tuple(map(tuple, runs)))
            yield gaps, *(counts[k] for k in ("blank", "duplicate", "truncated", "illegal")), cost, found

        return take, end

    return _per_conversation(rows, make, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the conversations after the edits that :func:`audits` found.

    Turns are taken by number, null the first; those that share one by role and then by hashes of
    their texts, so equal ones are neighbours. A null role or text is a space; an empty role is none of the
    legal ones; null conv_ids are one conversation. Other columns are not looked at. Rows of a conversation come out
    in order, in one task, which streams them; a conversation may have no rows.
    """
    rows = _plain(turns)
    lead = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    lead = lead.withColumns({"h1": F.lit(None).cast("long"), "h2": F.lit(None).cast("long"), "body": F.lit(False)})
    both = _ordered(lead.unionByName(rows.withColumn("body", F.lit(True))), "body")

    def make():
        give, place = None, 0

        def placed(each):
            nonlocal place
            for edit, role, text in each:
                yield place, edit, role, text
                place += 1

        def take(body, role, text):
            nonlocal give
            if not body:
                give = apply_audit(text)
                return ()
            return placed(give(role, text))

        return take, lambda: placed(give(None, None))

    return _per_conversation(both.select("conv_id", "body", "role", "text"), make, "conv_id long, place long, edit string, role string, text string", flush=512)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines, from turns as :func:`repaired` orders them."""

    def make():
        state, apart = sha256(), ""

        def take(role, text):
            nonlocal apart
            state.update(f"{apart}{role}:{text}".encode())
            apart = "\n"
            return ()

        return take, lambda: [(state.hexdigest(),)]

    return _per_conversation(turns.select("conv_id", "role", "text"), make, "conv_id long, repaired_sha256 string")


def repair_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The audits with the digest of the repaired conversation, that of an empty string if it has no turns."""
    found = stored(audits(turns, conversations), "audits")
    made = digests(repaired(turns, found)).withColumnRenamed("conv_id", "of")
    met = found.join(made.hint("merge"), F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    return met.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest())))

