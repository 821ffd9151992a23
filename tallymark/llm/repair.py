"""Conversation structure repair: the cheapest edits that make the roles alternate.

The rows of a conversation are kept, given another role, deleted, and joined by empty
turns, so that the initials of the roles read ``(s?(ua)+)?``: an optional system turn, then pairs of
user and assistant. Among the cheapest lists of edits the one whose letters come first
(D delete, I insert, K keep, R rerole) is taken.

How it runs. Rows are dealt by conversation once. Repeated rows are found by a window
over conversation, role and text, which the same dealing serves. Then three streams run over
the sorted rows, each carrying a state of a few numbers from one Arrow batch to the next,
so that a conversation of any length passes through in bounded memory:

1. Forwards: a least cost and a rank for each of the four states that the roles can be
   in (start, after system, after user, after assistant). Each row gets its compact
   backpointers (four bytes: for each state the edit that led to it) and the way to end
   here. They travel with the row, and Spark's sort spills them when a conversation
   is too large for memory.
2. Backwards, over the rows sorted in descending order: the backpointers are followed and each row
   gets its edit and the turns put before or after it.
3. Forwards again, for digests of a conversation (``summarise``).

Only the rank of the states' letters is kept, not the letters: after a row, no state's letters are
the beginning of another's, as all end with that row's edit, so ranks decide ties.

Defined cases: a null conversation id is a conversation of its own; a null role or text
counts as one space; null turns stand first; rows of one turn are in the order of
role and text; a role that is empty or has another initial can only be deleted or given another;
a repeated row counts as such after its first occurrence, blank rows as blank
first; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.lines import BLANKS

START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 99
#: A state dearer than the cheapest by more than this never wins: three empty turns and a
#: deletion at most bring the cheapest one to where it would lead.
BEHIND = 16
#: Costs of the edits; a truncated row that stays costs ``STAYS`` more.
KEEP, REROLE, DELETE, INSERT, STAYS = 0, 2, 3, 2, 1
FAULTS = ("blank", "duplicate", "truncated")
#: Digest of a conversation of which nothing is left.
EMPTY = hashlib.sha256().hexdigest()


def _next(state: int) -> int:
    """The state after a user or assistant turn, whichever may follow."""
    return ASSISTANT if state == USER else USER


def _edits(state: int, initial: str, fault: str | None) -> Iterator[tuple[str, int, int]]:
    """Letters, state after and cost of every way to take one row, empty turns before it included."""
    for inserts in range(3):
        cost, letters = INSERT * inserts, "I" * inserts
        yield letters + "D", state, cost + DELETE
        if fault not in ("blank", "duplicate"):
            stays = cost + (STAYS if fault == "truncated" else 0)
            if initial == "s" and state == START:
                yield letters + "K", SYSTEM, stays + KEEP
            if initial == ("a" if state == USER else "u"):
                yield letters + "K", _next(state), stays + KEEP
            yield letters + "R", _next(state), stays + REROLE
        state = _next(state)


Costs = tuple[int, int, int, int]


@lru_cache(maxsize=1 << 16)
def step(costs: Costs, ranks: Costs, initial: str, fault: str | None) -> tuple[Costs, Costs, int, int]:
    """States after a row: costs above the least, ranks, that least, and backpointers.

    A backpointer is six bits: state before, number of turns put before the row, edit.
    """
    best: list[tuple[int, int, str, int] | None] = [None] * 4
    for before in range(4):
        if costs[before] < FAR:
            for letters, after, cost in _edits(before, initial, fault):
                offer = (costs[before] + cost, ranks[before], letters, before)
                if best[after] is None or offer < best[after]:
                    best[after] = offer
    least = min(b[0] for b in best if b)
    best = [b if b and b[0] - least <= BEHIND else None for b in best]
    order = sorted((b[1], b[2], s) for s, b in enumerate(best) if b)
    place = {s: r for r, (_, _, s) in enumerate(order)}
    back = 0
    for state, b in enumerate(best):
        if b:
            back |= (b[3] | (len(b[2]) - 1) << 2 | "DKR".index(b[2][-1]) << 4) << 6 * state
    new = tuple(b[0] - least if b else FAR for b in best)
    return new, tuple(place.get(s, 4) for s in range(4)), least, back


@lru_cache(maxsize=1 << 12)
def ending(costs: Costs, ranks: Costs) -> tuple[int, int, int]:
    """Cost above the least, last state and turns put behind, if the conversation ends here."""
    ways = []
    for state in range(4):
        at = state
        for inserts in range(3):
            if costs[state] < FAR and at in (START, ASSISTANT):
                ways.append((costs[state] + INSERT * inserts, ranks[state], "I" * inserts, state))
            at = _next(at)
    cost, _, letters, state = min(ways)
    return cost, state, len(letters)


BEGIN: tuple[Costs, Costs] = ((0, FAR, FAR, FAR), (0, 4, 4, 4))


def judged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``__conv``, ``__turn``, ``__role``, ``__text``, ``__at`` (place from 1) and ``__fault``."""
    plain = rows.select(
        F.col(f"`{conv}`").alias("__conv"),
        F.col(f"`{turn}`").cast("long").alias("__turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("__role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("__text"),
    ).repartition("__conv")
    place = F.row_number().over(Window.partitionBy("__conv").orderBy(F.asc_nulls_first("__turn"), "__role", "__text"))
    nth = F.row_number().over(Window.partitionBy("__conv", "__role", "__text").orderBy("__at"))
    bare = F.btrim("__text", F.lit(BLANKS))
    return plain.withColumn("__at", place.cast("long")).withColumn("__nth", nth).select(
        "__conv", "__turn", "__role", "__text", "__at",
        F.when(bare == "", "blank").when(F.col("__nth") > 1, "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").alias("__fault"),
    )


_CARRIED = "__turn bigint, __role string, __text string, __at bigint, __fault string"


def _forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state, paid, last = BEGIN, 0, object()
    for batch in batches:
        backs, ends, costs = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("__conv", "__at", "__role", "__fault"))
        for conv, at, role, fault in zip(*columns, strict=True):
            if at == 1 or conv != last:
                state, paid, last = BEGIN, 0, conv
            new, ranks, least, back = step(*state, role[:1], fault)
            state, paid = (new, ranks), paid + least
            cost, end, behind = ending(new, ranks)
            backs.append(back)
            ends.append(end | behind << 2)
            costs.append(paid + cost)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(backs, pa.int32()), pa.array(ends, pa.int32()), pa.array(costs, pa.int64())],
            names=[*batch.schema.names, "__back", "__end", "__cost"],
        )


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state, last, following, total = START, object(), 1, 0
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("__conv", "__at", "__back", "__end", "__cost"))
        for conv, at, back, end, cost in zip(*columns, strict=True):
            behind: list[str] = []
            if following == 1 or conv != last:
                last, total = conv, cost
                state = end & 3
                behind = _turns(state, end >> 2)
            bits = back >> 6 * state & 63
            before, count, edit = bits & 3, bits >> 2 & 3, "DKR"[bits >> 4]
            ahead = _turns(before, count)
            role = None if edit != "R" else "user" if state == USER else "assistant"
            out.append((ahead, edit, role, behind, total))
            state, following = before, at
        ahead, edit, role, behind, totals = (list(c) for c in zip(*out, strict=True)) if out else ([] for _ in range(5))
        kept = batch.drop_columns(["__back", "__end", "__cost"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(ahead, pa.list_(pa.string())), pa.array(edit, pa.string()), pa.array(role, pa.string()), pa.array(behind, pa.list_(pa.string())), pa.array(totals, pa.int64())],
            names=[*kept.schema.names, "__ahead", "__edit", "__new", "__behind", "__cost"],
        )


def _turns(state: int, count: int) -> list[str]:
    out = []
    for _ in range(count):
        state = _next(state)
        out.append("user" if state == USER else "assistant")
    return out


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per edit: conversation, ``step`` (ascending), ``edit``, ``role`` and ``text`` of the
    repaired turn (null if deleted), and of the turn it came from ``turn``, ``old_role`` and
    ``fault`` (null for an inserted one); ``total`` is the conversation's cost.

    The rows of a conversation lie in one partition, in the order of their steps.
    """
    kind = rows.schema[conv].dataType.simpleString()
    found = judged(rows, conv, turn, role, text).sortWithinPartitions("__conv", "__at")
    walked = found.mapInArrow(_forwards, f"__conv {kind}, {_CARRIED}, __back int, __end int, __cost bigint")
    back = walked.sortWithinPartitions("__conv", F.desc("__at")).mapInArrow(
        _backwards, f"__conv {kind}, {_CARRIED}, __ahead array<string>, __edit string, __new string, __behind array<string>, __cost bigint"
    )
    empty = lambda roles, place: F.transform(roles, lambda r, i: _edit(F.lit("I"), r, F.lit(""), F.lit(place) + i))
    taken = F.when(F.col("__edit") != "D", F.coalesce("__new", "__role"))
    own = F.array(_edit(F.col("__edit"), taken, F.when(F.col("__edit") != "D", F.col("__text")), F.lit(4)))
    edits = back.withColumn("__e", F.explode(F.concat(empty(F.col("__ahead"), 0), own, empty(F.col("__behind"), 5))))
    source = lambda c: F.when(F.col("__e.edit") != "I", F.col(c))
    return edits.select(
        F.col("__conv").alias(conv),
        (F.col("__at") * F.lit(8) + F.col("__e.place")).alias("step"),
        F.col("__e.edit").alias("edit"),
        F.col("__e.role").alias("role"),
        F.col("__e.text").alias("text"),
        source("__turn").alias("turn"),
        source("__role").alias("old_role"),
        source("__fault").alias("fault"),
        F.col("__cost").alias("total"),
    ).sortWithinPartitions(conv, "step")


def _edit(edit: Column, role: Column, text: Column, place: Column) -> Column:
    return F.struct(edit.alias("edit"), role.alias("role"), text.alias("text"), place.alias("place"))


class _Summary:
    """What is carried while a conversation's edits pass by."""

    def __init__(self, conv):
        self.conv, self.counts = conv, dict.fromkeys((*FAULTS, "illegal"), 0)
        self.first = self.latest = self.before = None
        self.turns = self.cost = 0
        self.letters: list[str] = []
        self.digest, self.begun = hashlib.sha256(), False

    def add(self, edit, role, text, turn, old_role, fault, total) -> None:
        self.letters.append(edit)
        self.cost = total
        if role is not None:
            self.digest.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
            self.begun = True
        if edit == "I":
            return
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + old_role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.before = old_role[:1]
        if turn is not None and turn != self.latest:
            self.first = turn if self.first is None else self.first
            self.latest, self.turns = turn, self.turns + 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.latest - self.first + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), self.cost, "".join(self.letters), self.digest.hexdigest())


def summarise(edits: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation: ``gaps``, counts of faults, ``illegal`` neighbours, ``cost``,
    ``audit`` (the edits' letters) and ``repaired_sha256``; reads what ``repair`` returns.
    """
    kind = edits.schema[conv].dataType.simpleString()
    names = ["gaps", *FAULTS, "illegal", "cost"]
    schema = f"__conv {kind}, {', '.join(f'{n} bigint' for n in names)}, audit string, repaired_sha256 string"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, types = None, None, None

        def flush(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[]] * 9
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["__conv", *names, "audit", "repaired_sha256"])

        for batch in batches:
            types = [batch.column(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            done = []
            for conv_id, number, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or conv_id != held.conv or number < last:
                    if held is not None:
                        done.append(held.row())
                    held = _Summary(conv_id)
                held.add(*rest)
                last = number
            yield flush(done)
        if held is not None:
            yield flush([held.row()])

    columns = [conv, "step", "edit", "role", "text", "turn", "old_role", "fault", "total"]
    return edits.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(stream, schema).withColumnRenamed("__conv", conv)


def all_states() -> Iterator[tuple[Costs, Costs]]:
    """Every state that rows can lead to; there are few, so ``step`` remembers them all."""
    seen, new = {BEGIN}, [BEGIN]
    while new:
        found = [step(*s, i, f)[:2] for s, i, f in product(new, "suax", (None, *FAULTS))]
        new = [s for s in dict.fromkeys(found) if s not in seen]
        seen.update(new)
    yield from seen
