"""Chat formatting with minimum-cost role repair.

A conversation is legal if an optional system message comes first, then user
and assistant take turns, and the assistant has the last word.  Each turn may
be kept, relabelled, merged into the message before it, or preceded by empty
messages; dynamic programming over the automaton of legal roles finds the
cheapest repair, which is then rendered.

The cost of a stretch of turns from one role to another is a small table, and
tables of neighbouring stretches combine (min-plus), so a conversation of any
length is cut into stretches of ``STRETCH`` turns: tables per stretch, entry
and exit roles per conversation, then the choices within each stretch.  The
rendered result is one piece per turn or insertion; joined in order they are
the conversation, and none of them grows with it.

Defined results: turns are ordered by turn number (null last), then role and
text, so ties and repeated rows have one order and every row keeps a place;
a null or unknown role fits any role at a small cost; null text is empty;
rows without a conversation id form one conversation; markers inside a text
are broken up so that they do not render as markers.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from smelter.llm.common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
LAST = (ASSISTANT,)
#: Costs, in tenths: merging into the message before, an empty message,
#: another role for a known role, a role for an unknown one.
MERGE, INSERT, RELABEL, LABEL = 4, 9, 10, 3
NEVER = 1 << 40
STRETCH = 4096

OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"


@cache
def between(start: int, goals: tuple[int, ...]) -> tuple[int, ...] | None:
    """The fewest empty messages that lead from ``start`` to where one of
    ``goals`` may come next (or, for an end, where it has come)."""
    paths = [()]
    for _ in range(len(ROLES)):
        for path in paths:
            if set(goals) & set(NEXT[path[-1] if path else start]):
                return path
        paths = [p + (r,) for p in paths for r in NEXT[p[-1] if p else start]]
    return None


@cache
def ending(state: int) -> tuple[int, ...] | None:
    """The empty messages that bring a conversation to a legal end."""
    if state == START or state in LAST:
        return ()
    paths = [(r,) for r in NEXT[state]]
    for _ in range(len(ROLES)):
        for path in paths:
            if path[-1] in LAST:
                return path
        paths = [p + (r,) for p in paths for r in NEXT[p[-1]]]
    return None


@cache
def step(state: int, role: int, label: int) -> tuple[int, str, tuple[int, ...]]:
    """(cost, action, empty messages before) of giving a turn of ``role`` the
    role ``label`` after a message of ``state``."""
    price = 0 if role == label else LABEL if role == START else RELABEL
    named = "" if role == label else "relabel"
    if state == label and state != START:
        return MERGE + price, "+".join(filter(None, ["merge", named])), ()
    path = between(state, (label,))
    if label == START or path is None:
        return NEVER, "", ()
    return INSERT * len(path) + price, named or "keep", path


#: Cost of each step, by the turn's role: from each state to each label.
_CHOICES = [np.array([[step(p, role, q)[0] for q in range(4)] for p in range(4)], np.int64) for role in range(4)]


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cheapest way through two stretches, from each role to each role."""
    return np.minimum((a[:, :, None] + b[None]).min(1), NEVER)


def stretch_costs(roles: list[int]) -> np.ndarray:
    total = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(total, 0)
    for role in roles:
        total = combine(total, _CHOICES[role])
    return total


def best_labels(roles: list[int], entry: int, exit: int) -> list[int]:
    """The labels of the cheapest way through a stretch; of equal ones, the
    way whose last label is the lowest, then the one before it, and so on."""
    reach = [np.full(4, NEVER, np.int64)]
    reach[0][entry] = 0
    for role in roles:
        reach.append(np.minimum((reach[-1][:, None] + _CHOICES[role]).min(0), NEVER))
    labels, at = [], exit
    for i in range(len(roles), 0, -1):
        labels.append(at)
        ways = reach[i - 1] + _CHOICES[roles[i - 1]][:, at]
        at = int(np.argmin(ways))
    return labels[::-1]


def exits(tables: list[np.ndarray]) -> list[tuple[int, int]]:
    """Entry and exit role of each stretch of a conversation."""
    reach = [np.array([0, NEVER, NEVER, NEVER], np.int64)]
    for table in tables:
        reach.append(np.minimum((reach[-1][:, None] + table).min(0), NEVER))
    tail = np.array([INSERT * len(e) if (e := ending(s)) is not None else NEVER for s in range(4)], np.int64)
    at = int(np.argmin(reach[-1] + tail))
    out = []
    for i in range(len(tables), 0, -1):
        before = int(np.argmin(reach[i - 1] + tables[i - 1][:, at]))
        out.append((before, at))
        at = before
    return out[::-1]


def clean(text: str | None) -> str:
    return (text or "").replace("<|", "< |").replace("|>", "| >")


def pieces(roles: list[int], texts: list[str | None], entry: int, exit: int, first: int, last: bool):
    """Rows (place, part, role, action, rendered) of one stretch."""
    state = entry
    for i, (role, label) in enumerate(zip(roles, best_labels(roles, entry, exit), strict=True)):
        _, action, empty = step(state, role, label)
        for k, r in enumerate(empty):
            yield first + i, k, ROLES[r], "insert", (CLOSE if state != START or k else "") + OPEN.format(ROLES[r])
        if "merge" in action:
            head = "\n\n"
        else:
            head = (CLOSE if state != START or empty else "") + OPEN.format(ROLES[label])
        yield first + i, len(empty), ROLES[label], action, head + clean(texts[i])
        state = label
    if last:
        end = ending(state)
        for k, r in enumerate(end):
            yield first + len(roles), k, ROLES[r], "insert", CLOSE + OPEN.format(ROLES[r])
        yield first + len(roles), len(end), "", "end", CLOSE


def _by_run(rows: DataFrame, by: list[str], order: list[str], what, schema: T.StructType) -> DataFrame:
    """Apply ``what(rows)``, which yields tuples, to each run of equal ``by``."""
    names = schema.names

    def run(batches):
        at, held, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[c] for c in by)
                if held and key != at:
                    out.extend(what(held))
                    held = []
                    if len(out) > 5_000:
                        yield batch_of(out)
                        out = []
                at = key
                held.append(row)
        if held:
            out.extend(what(held))
        if out:
            yield batch_of(out)

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names)

    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    return rows.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, schema)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rendered pieces of repaired conversations: conv, place (of the turn in
    its conversation, from 0), part (insertions before a turn come first),
    turn, role, action (keep, relabel, merge, merge+relabel, insert, end) and
    rendered."""
    code = F.when(turns[role] == "system", SYSTEM).when(turns[role] == "user", USER).when(
        turns[role] == "assistant", ASSISTANT).otherwise(START)
    rows = turns.select(turns[conv].alias("conv"), turns[turn].alias("turn"), code.alias("code"),
                        turns[role].cast("string").alias("role"), turns[text].cast("string").alias("text"))
    order = ["conv", F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last()]
    # a range of rows per task: a long conversation spans several
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("at", F.monotonically_increasing_id())
                    .withColumn("stretch", F.floor(F.col("at") / STRETCH)).drop("role"), "turns")
    kind = placed.schema["conv"].dataType
    field, number = lambda n, t: T.StructField(n, t), T.LongType()

    def table(run):
        yield (run[0]["conv"], run[0]["stretch"], len(run), stretch_costs([r["code"] for r in run]).ravel().tolist())

    tables = _by_run(placed.select("conv", "stretch", "at", "code"), ["conv", "stretch"], ["at"], table, T.StructType([
        field("conv", kind), field("stretch", number), field("size", number), field("costs", T.ArrayType(number))]))

    def ends(run):
        first = 0
        found = exits([np.array(r["costs"], np.int64).reshape(4, 4) for r in run])
        for i, (r, (entry, exit)) in enumerate(zip(run, found, strict=True)):
            yield r["conv"], r["stretch"], entry, exit, first, i == len(run) - 1
            first += r["size"]

    ways = _by_run(tables, ["conv"], ["stretch"], ends, T.StructType([
        field("conv", kind), field("stretch", number), field("entry", number), field("exit", number),
        field("first", number), field("last", T.BooleanType())]))

    def render(run):
        one = run[0]
        for place, part, name, action, text in pieces([r["code"] for r in run], [r["text"] for r in run],
                                                      one["entry"], one["exit"], one["first"], one["last"]):
            i = place - one["first"]
            yield one["conv"], place, part, run[i]["turn"] if i < len(run) else None, name, action, text

    ways = ways.withColumnsRenamed({"conv": "of", "stretch": "way"})
    joined = placed.join(ways, placed["conv"].eqNullSafe(ways["of"]) & (placed["stretch"] == ways["way"])).drop("of", "way")
    out = _by_run(joined, ["conv", "stretch"], ["at"], render, T.StructType([
        field("conv", kind), field("place", number), field("part", number), field("turn", placed.schema["turn"].dataType),
        field("role", T.StringType()), field("action", T.StringType()), field("rendered", T.StringType())]))
    return out.withColumnsRenamed({"conv": conv, "turn": turn})


def whole(pieces: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, rendered): one string per conversation, for conversations that
    fit one row; ``repair`` itself has no such bound."""
    parts = F.sort_array(F.collect_list(F.struct("place", "part", "rendered")))
    return pieces.groupBy(conv).agg(F.array_join(F.transform(parts, lambda p: p["rendered"]), "").alias("rendered"))
