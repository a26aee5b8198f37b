"""Conversation repair against all edit strings of short conversations, and a search with whole strings of long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assocframe.llm import repair
from assocframe.llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"
COST = {"K": 0, "R": 1, "D": 2, "I": 5}


def faults_of(rows):
    """Per row (blank, duplicate, truncated) by the definition."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        blank = not bare
        duplicate = not blank and (role, text) in seen
        seen.add((role, text))
        out.append((blank, duplicate, not blank and not duplicate and bare[-1] not in ".!?"))
    return out


def apply(rows, faults, letters):
    """Cost and repaired rows of an edit string, or None where it is not allowed."""
    total, out, at = 0, [], 0
    for letter in letters:
        initials = "".join(r[:1] for r, _ in out)
        turn = "assistant" if initials.endswith("u") else "user"
        total += COST[letter]
        if letter == "I":
            out.append((turn, ""))
            continue
        (_, role, text), (blank, duplicate, truncated) = rows[at], faults[at]
        at += 1
        if letter == "D":
            continue
        if blank or duplicate:
            return None
        total += 5 * truncated
        out.append((role if letter == "K" else turn, text))
    initials = "".join(r[:1] or "?" for r, _ in out)
    return (total, out) if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials) else None


def cheapest_of_all(rows, faults):
    """Every edit string with at most two inserts between rows."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for inserts in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            letters = "".join(i + e for i, e in zip(inserts, (*edits, "")))
            found = apply(rows, faults, letters)
            if found and (best is None or (found[0], letters) < best[:2]):
                best = (found[0], letters, found[1])
    return best


def cheapest_with_strings(rows, faults):
    """States hold whole edit strings; whatever ends in a state at the least cost, the least string."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def closure(states):
        for _ in range(3):
            for state, (cost, letters) in list(states.items()):
                to = "a" if state == "u" else "u"
                way = (cost + 5, letters + "I")
                states[to] = min(states.get(to, way), way)
        return states

    states = {"": (0, "")}
    for (_, role, _), (blank, duplicate, truncated) in zip(rows, faults):
        new = {}
        for state, (cost, letters) in closure(dict(states)).items():
            ways = [(state, 2, "D")]
            if not (blank or duplicate):
                if role[:1] and role[:1] in follow[state]:
                    ways.append((role[:1], 5 * truncated, "K"))
                ways.append(("a" if state == "u" else "u", 1 + 5 * truncated, "R"))
            for to, more, letter in ways:
                way = (cost + more, letters + letter)
                new[to] = min(new.get(to, way), way)
        states = new
    ends = closure(states)
    cost, letters = min(ends[s] for s in ("", "a") if s in ends)
    return cost, letters, apply(rows, faults, letters)[1]


def summary(rows, cheapest=cheapest_with_strings):
    faults = faults_of(rows)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = ("".join((a[1][:1], b[1][:1])) for a, b in zip(rows, rows[1:]))
    cost, letters, out = cheapest(rows, faults) if rows else (0, "", [])
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(sum(f[k] for f in faults) for k in range(3)),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost, letters, hashlib.sha256(text.encode()).hexdigest(),
    )


ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b", "", "c!"])), max_size=6)


@settings(deadline=None, max_examples=40)
@given(ROWS.filter(lambda rows: len(rows) < 5))
def test_strings_search_finds_the_best_of_all(rows):
    rows = [(k, *r) for k, r in enumerate(rows)]
    faults = faults_of(rows)
    assert cheapest_with_strings(rows, faults) == cheapest_of_all(rows, faults)


def searched(rows, faults, parts=1):
    """The operator's search alone, in runs that meet as those of different tasks do."""
    search, letters = repair.Survivors(), []
    most = 0
    for (_, role, _), (blank, duplicate, truncated) in zip(rows, faults):
        letters += search.step(repair.initial_of(role), blank or duplicate, truncated)
        most = max(most, len(search.nodes))
    cost, _, rest, ending = search.finish()
    return cost, "".join([*letters, *rest, ending]), most


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b", "", "c!", "d?", "e."])), max_size=30))
def test_search(rows):
    rows = [(k, *r) for k, r in enumerate(rows)]
    faults = faults_of(rows)
    assert searched(rows, faults)[:2] == cheapest_with_strings(rows, faults)[:2]


def test_memory_stays_bounded_where_survivors_meet():
    draw = random.Random(1)
    rows = [(0, "system", "s.")] + [(k, draw.choice(["user", "assistant"]), f"{k}.") for k in range(20_000)]
    cost, letters, most = searched(rows, faults_of(rows))
    assert most < 300 and sum(c != "I" for c in letters) == len(rows)


def expected(rows):
    """All conversations of (conv_id, turn, role, text) rows by definition, after damage."""
    kept, ids = {}, set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        kept.setdefault(conv, []).extend([(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1))
    return ids, kept


def same(got, ids, kept, order=None):
    found = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert set(found) == ids
    for conv in ids:
        rows = sorted(kept.get(conv, []), key=order or (lambda r: (r[0] is not None, r[0] or 0)))
        assert found[conv] == summary(rows), conv


def test_query(spark, small):
    got = QUERIES["op13_conversation_repair"](spark, small)
    assert got.columns == list(repair.RESULTS)
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(got, *expected(rows))


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def hot_rows(roles, repeats):
    draw = random.Random(5)
    rows = []
    for turn in range(900):
        # Some turns are missing; texts come again far away.
        if draw.random() < 0.95:
            rows.append((7, turn, draw.choice(roles), f"text {turn % repeats}" + draw.choice([".", "", "!"])))
    rows += [(conv, turn, role, f"{turn}.") for conv in (None, 1, 9) for turn, role in enumerate(["user", "assistant", "user"])]
    return rows


@pytest.mark.parametrize("roles, repeats", [(["user", "assistant", "system"], 1000), (["tool"], 1000), (["user", "assistant", "x"], 50)])
def test_conversation_in_many_tasks(spark, many_parts, roles, repeats):
    rows = hot_rows(roles, repeats)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    placed = repair._sorted_rows(repair.damage(df))
    assert repair._crossing(placed).count() >= 1
    got = repair.with_all_ids(repair.repair_conversations(repair.damage(df)), df)
    same(got, *expected(rows))
    # The rows themselves give the same digest.
    out = [r for r in repair.repaired_rows(repair.damage(df)).orderBy("position").collect() if r["conv_id"] == 7]
    lines = "\n".join(f"{r['role']}:{r['text']}" for r in out if r["role"] is not None)
    mine = next(r for r in got.collect() if r["conv_id"] == 7)
    assert "".join(r["edit"] for r in out) == mine["audit"]
    assert hashlib.sha256(lines.encode()).hexdigest() == mine["repaired_sha256"]


def test_seen_in_an_earlier_task_by_shuffle(spark, many_parts, monkeypatch):
    monkeypatch.setattr(repair, "_BROADCAST_ROWS", 0)
    rows = hot_rows(["user", "assistant"], 60)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    same(repair.with_all_ids(repair.repair_conversations(repair.damage(df)), df), *expected(rows))


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "no turn."), (1, None, None, None), (1, 3, "assistant", "yes." + " long" * 200_000 + "."),
        (2, None, None, "x"), (2, None, "", "y."), (None, 1, "user", "hello."), (None, 2, "assistant", "hi!"),
        (3, 5, "system", " \t\n"), (4, 1, "system", "s."), (5, -3, "user", "é."), (5, 9, "assistant", "a?\n"),
    ]
    clash = ", ".join(f"{c} string" for c in ("_part", "_place", "_conv", "entry", "crosses", "copy", "digest"))
    df = spark.createDataFrame([(*r, *["z"] * 7) for r in rows], f"conv_id long, turn long, role string, text string, {clash}")
    ids, kept = expected(rows)
    # Rows without a turn go by role.
    same(repair.with_all_ids(repair.repair_conversations(repair.damage(df)), df), ids, kept, lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_repeated_rows(spark):
    rows = [(1, 2, "user", "same."), (1, 2, "user", "same."), (1, 2, "user", "same."), (1, 4, "assistant", "ok.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = repair.repair_conversations(df).first()
    assert (r["gaps"], r["duplicate"], r["audit"], r["cost"]) == (1, 2, "KDDK", 4)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.with_all_ids(repair.repair_conversations(repair.damage(df)), df).isEmpty()
    assert repair.repaired_rows(df).isEmpty()
