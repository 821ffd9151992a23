"""Conversation repair against a search over all edits, in one and in many batches."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tallymark.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SAYS = ["All is said.", "Is it?", "no end", "", " \n", "other words!"]


def _conversations():
    rng = random.Random(11)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 5)):
            shown = rng.choice([turn, turn, turn, turn + 2, None])
            rows.append((conv, shown, rng.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"]), rng.choice([*SAYS, None])))
    rows += [(50, t, ("user", "assistant")[t % 2], f"line {t}.") for t in range(400)]
    rows += [(51, 0, "user", "once.")] * 3
    rng.shuffle(rows)
    return rows


ROWS = _conversations()


def _faults(rows):
    seen = set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        yield "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))


def _cheapest(rows):
    """Every list of edits within the best cost so far, two empty turns at most in a place."""
    faults, best = list(_faults(rows)), [(10**9, "", [])]

    def go(at, roles, audit, cost, turns, inserts):
        if cost > best[0][0]:
            return
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles) and (cost, audit) < best[0][:2]:
            best[0] = (cost, audit, turns)
        if at < len(rows):
            _, role, text = rows[at]
            go(at + 1, roles, audit + "D", cost + 3, turns, 0)
            if faults[at] not in ("blank", "duplicate"):
                more = faults[at] == "truncated"
                if role[:1] and role[0] in "sua":
                    go(at + 1, roles + role[0], audit + "K", cost + more, [*turns, (role, text)], 0)
                for new in ("user", "assistant"):
                    go(at + 1, roles + new[0], audit + "R", cost + 2 + more, [*turns, (new, text)], 0)
        if inserts < 2:
            for new in ("user", "assistant"):
                go(at, roles + new[0], audit + "I", cost + 2, [*turns, (new, "")], inserts + 1)

    go(0, "", "", 0, [], 0)
    return best[0]


def _expected(rows):
    """[(conv, turn, role, text)] of one conversation to its summary."""
    plain = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for _, t, r, x in rows))
    plain = [(t if has else None, r, x) for has, t, r, x in plain]
    turns = {t for t, _, _ in plain if t is not None}
    faults = list(_faults(plain))
    initials = [r[:1] for _, r, _ in plain]
    cost, audit, kept = _cheapest(plain)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in repair.FAULTS),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def summary(spark):
    extra = [(*r, "x", 1) for r in ROWS]
    return spark.createDataFrame(extra, SCHEMA + ", step string, __at int").repartition(5)


@pytest.mark.parametrize("batch", [7, 10000])
def test_repair_equals_a_search_over_all_edits(spark, summary, batch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = {r.conv_id: tuple(r)[1:] for r in repair.summarise(repair.repair(summary)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    groups = {}
    for row in ROWS:
        groups.setdefault(row[0], []).append(row)
    long = groups.pop(50)
    assert found.pop(50) == (0, 0, 0, 0, 0, 0, "K" * len(long), hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in sorted(long)).encode()).hexdigest())
    assert found == {conv: _expected(rows) for conv, rows in groups.items()}


def test_steps_state_what_became_of_every_row(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "user", "Well"), (1, 2, "user", " ")], SCHEMA)
    out = [tuple(r)[2:] for r in repair.repair(rows).orderBy("step").collect()]
    assert out == [("I", "user", "", None, None, None, 8), ("K", "assistant", "Hello.", 0, "assistant", None, 8), ("D", None, None, 1, "user", "truncated", 8), ("D", None, None, 2, "user", "blank", 8)]
    other = rows.replace("assistant", "tool", subset="role")
    out = [tuple(r)[2:5] for r in repair.repair(other).orderBy("step").collect()]
    assert out == [("R", "user", "Hello."), ("R", "assistant", "Well"), ("D", None, None)]


def test_one_shuffle_and_no_rows(spark, summary):
    plan = repair.summarise(repair.repair(summary))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(__conv") == 1 and plan.count("Exchange hashpartitioning") == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.summarise(repair.repair(empty)).count() == 0


def test_few_states_exist():
    assert len(list(repair.all_states())) < 1000


def test_kinds_of_ids(spark):
    rows = spark.createDataFrame([("a", 1, "user", "One."), ("a", 2, "assistant", "Two.")], SCHEMA.replace("conv_id bigint", "conv_id string"))
    out = repair.summarise(repair.repair(rows)).first()
    assert (out.conv_id, out.audit, out.cost) == ("a", "KK", 0)
