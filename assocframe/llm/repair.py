"""Conversation structure repair: the cheapest edits after which roles alternate, by a Viterbi search.

The rows of a conversation must become ``(s?(ua)+)?`` in role initials.  Edits
are Keep (0), Rerole to user or assistant (1), Delete (2) and Insert of an empty
row (5); a row that is blank or repeats an earlier one must be deleted, and a
truncated row that stays costs 5 more.  Of the cheapest edit strings the least
one in ASCII order wins.

States say what was given out so far: nothing, a system row, a user row, or a
whole pair.  Each step keeps one survivor per state.  Survivors are leaves of a
tree of back pointers with reference counts: a node nobody needs any more is
freed, and as soon as all survivors share an ancestor its edits are given out
and its row is forgotten, so memory holds unresolved rows only.  Two survivors
of one step hold equally many row letters and end in one, so neither is a prefix
of the other; the order of their complete unresolved suffixes is carried on from
step to step as ranks, which decides every tie as comparing the suffixes would.

Rows are sorted over all tasks by conversation, turn (NULL first), role and a
hash of the text, and written once, so a conversation that holds a third of all rows is
many runs in as many tasks.  Conversations inside one task are finished there.
A run of a conversation that crosses tasks gives, per state before and after it,
cost and rank (at most 16 numbers); those of one conversation, at most one run
per task, tell the states at which its runs meet, and the runs are then repaired
apart.  Only the SHA-256 of such a conversation reads its repaired rows one
after the other, as that hash must, in a stream that holds one row.

Odd cases: a NULL role or text is one space; a NULL id is a conversation of its
own; NULL turns come first and are no turn in ``gaps``; rows of one turn go by
role, then by hash of the text, and equal rows are duplicates of the first; an
empty role has no initial and can be reroled or deleted; a very long text costs
its length, and is held while unresolved; other columns are not looked at, so
their names cannot clash; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from assocframe.plans.materialize import fits, materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

NOTHING, SYSTEM, USER, PAIR = range(4)
ROLES = {USER: "user", PAIR: "assistant"}
#: What may be given out in a state: initial of the row, state after it.
NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": PAIR}, PAIR: {"u": USER}}
LEGAL = {"su", "ua", "au"}

_INF = float("inf")
_BROADCAST_ROWS, _BROADCAST_BYTES = 200_000, 64 << 20
_SLICE = 512


def after_insert(state: int) -> int:
    """The state after an inserted row, which is never a system row."""
    return PAIR if state == USER else USER


def _inserted(state: int) -> list[tuple[int, int, str]]:
    """State, cost and letters after no, one or two inserts; more only come back to a state at a cost."""
    one = after_insert(state)
    ways = [(state, 0, ""), (one, INSERT, "I")]
    if state in (NOTHING, SYSTEM):
        ways.append((after_insert(one), 2 * INSERT, "II"))
    return ways


def _moves(initial: str, must_go: bool, truncated: bool) -> list[list[tuple[int, int, str]]]:
    """Per state after a row: (state before it, cost, letters), the best way for each state before."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    stay = TRUNCATED if truncated else 0
    for before in NEXT:
        for state, cost, letters in _inserted(before):
            ways = [(state, DELETE, "D")]
            if not must_go:
                if initial in NEXT[state]:
                    ways.append((NEXT[state][initial], KEEP + stay, "K"))
                ways.append((after_insert(state), REROLE + stay, "R"))
            for after, more, letter in ways:
                way = (cost + more, letters + letter)
                if way < best.get((before, after), (_INF, "")):
                    best[before, after] = way
    return [[(b, *way) for (b, a), way in sorted(best.items()) if a == after] for after in NEXT]


MOVES = {key: _moves(*key) for key in product(("s", "u", "a", ""), (False, True), (False, True))}
#: Cost and letters of the inserts that end a conversation in a state.
ENDINGS = {NOTHING: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), PAIR: (0, "")}


class Survivors:
    """One survivor per state, as leaves of a tree of back pointers that gives out what all of them share."""

    def __init__(self, entry: int = NOTHING):
        self.cost: list[float] = [_INF] * 4
        self.rank = [0] * 4
        self.leaf: list[int | None] = [None] * 4
        self.cost[entry], self.leaf[entry] = 0, 0
        # number: [parent, letters, references, sum of its children's numbers]
        self.nodes: dict[int, list] = {0: [None, "", 1, 0]}
        self.base, self.made = 0, 0

    def step(self, initial: str, must_go: bool, truncated: bool) -> list[str]:
        """Take a row; the letters that are settled now, one item per settled row."""
        cost, rank, leaf = self.cost, self.rank, self.leaf
        new = []
        for after, ways in enumerate(MOVES[initial, must_go, truncated]):
            best = None
            for before, more, letters in ways:
                if cost[before] < _INF:
                    way = (cost[before] + more, rank[before], letters, before)
                    if best is None or way < best:
                        best = way
            if best is not None:
                new.append((best, after))
        self._prune(new)
        self.cost, self.rank, self.leaf = [_INF] * 4, [0] * 4, [None] * 4
        new.sort(key=lambda way: way[0][1:3])
        for place, ((total, _, letters, before), after) in enumerate(new):
            self.made += 1
            parent = leaf[before]
            self.nodes[self.made] = [parent, letters, 1, 0]
            self.nodes[parent][2] += 1
            self.nodes[parent][3] += self.made
            self.cost[after], self.rank[after], self.leaf[after] = total, place, self.made
        for old in leaf:
            self._release(old)
        return list(self._settled())

    @staticmethod
    def _prune(new: list) -> None:
        """Drop survivors that a whole pair always beats: they would hold the tree open for ever.

        After a pair all goes on as after nothing, but for keeping a system row,
        which a pair makes up for by deleting it; and as after a system row.
        """
        at = {after: way[:3] for way, after in new}
        if PAIR not in at:
            return
        pair = at[PAIR]
        if NOTHING in at and pair[0] + DELETE < at[NOTHING][0]:
            new[:] = [x for x in new if x[1] != NOTHING]
        if SYSTEM in at and pair < at[SYSTEM]:
            new[:] = [x for x in new if x[1] != SYSTEM]

    def _release(self, number: int | None) -> None:
        while number is not None:
            node = self.nodes[number]
            node[2] -= 1
            if node[2]:
                return
            parent = node[0]
            del self.nodes[number]
            if parent is not None:
                self.nodes[parent][3] -= number
            number = parent

    def _settled(self) -> Iterator[str]:
        held = set(self.leaf)
        while self.base not in held and self.nodes[self.base][2] == 1:
            child = self.nodes[self.base][3]
            del self.nodes[self.base]
            self.base = child
            self.nodes[child][0] = None
            yield self.nodes[child][1]

    def finish(self, exit_state: int | None = None) -> tuple[int, int, list[str], str]:
        """Cost, last state, letters of the unsettled rows and of the ending.

        With ``exit_state`` the survivor of that state, without an ending.
        """
        if exit_state is None:
            ends = [(self.cost[s] + ENDINGS[s][0], self.rank[s], ENDINGS[s][1], s) for s in NEXT if self.cost[s] < _INF]
            total, _, ending, state = min(ends)
        else:
            total, ending, state = self.cost[exit_state], "", exit_state
        letters, at = [], self.leaf[state]
        while at != self.base:
            node = self.nodes[at]
            letters.append(node[1])
            at = node[0]
        return int(total), state, letters[::-1], ending


def initial_of(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


class Emitter:
    """Turns settled letters and their rows into repaired rows: (letter, role, text); a deleted row has neither."""

    def __init__(self, state: int = NOTHING):
        self.state = state

    def rows(self, letters: str, role: str = "", text: str = "") -> Iterator[tuple[str, str | None, str | None]]:
        for letter in letters:
            if letter == "D":
                yield letter, None, None
                continue
            if letter == "K":
                self.state = NEXT[self.state][role[:1]]
                yield letter, role, text
                continue
            self.state = after_insert(self.state)
            yield letter, ROLES[self.state], "" if letter == "I" else text


class Digest:
    """SHA-256 of ``role:text`` rows joined by newlines, and their edits."""

    def __init__(self):
        self.sha, self.first, self.edits = hashlib.sha256(), True, []

    def add(self, letter: str, role: str | None, text: str | None) -> None:
        self.edits.append(letter)
        if role is None:
            return
        line = f"{role}:{text}" if self.first else f"\n{role}:{text}"
        self.first = False
        self.sha.update(line.encode("utf-8", "surrogatepass"))


# Faults ---------------------------------------------------------------------------

_NO_SPACE = r"[^\x20\x09-\x0D]"


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows of all conversations in order, written once; ``_part`` is the task's number, ``_place`` the order."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    last = F.regexp_extract(text, _NO_SPACE + r"(?=[\x20\x09-\x0D]*\z)", 0)
    cut = F.when(last == "", F.lit(None)).otherwise(~last.isin(".", "!", "?"))
    named = rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), cut.alias("truncated"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.monotonically_increasing_id().alias("_read"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), "_read"]
    placed = named.orderBy(*order).drop("_read").withColumn("_place", F.monotonically_increasing_id())
    return materialize(placed).withColumn("_part", F.shiftright("_place", 33))


def _crossing(placed: DataFrame) -> DataFrame:
    """Conversations with rows in more than one task; they number fewer than the tasks do."""
    ends = placed.groupBy("_part").agg(F.min_by("conv_id", "_place").alias("a"), F.max_by("conv_id", "_place").alias("b"))
    met = ends.select("_part", F.explode(F.array("a", "b")).alias("conv_id")).distinct()
    return met.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("conv_id").alias("_conv"))


def _with_earlier(placed: DataFrame) -> DataFrame:
    """Adds ``crosses`` and ``earlier``: whether the row was seen in the conversation in an earlier task.

    Inside a task its own memory of digests tells; only what a crossing
    conversation repeats between tasks travels, each digest once a task.
    """
    crossing = materialize(_crossing(placed))
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    marked = placed.join(F.broadcast(crossing.withColumn("crosses", F.lit(True))), same, "left").drop("_conv")
    marked = marked.withColumn("crosses", F.coalesce("crosses", F.lit(False)))
    digests = placed.join(F.broadcast(crossing), same).select("_conv", "digest", "_part").distinct()
    parts = digests.groupBy("_conv", "digest").agg(F.collect_set("_part").alias("parts")).filter("size(parts) > 1")
    later = F.filter("parts", lambda p: p > F.array_min("parts"))
    seen = materialize(parts.select("_conv", F.col("digest").alias("_digest"), F.explode(later).alias("_later"), F.lit(True).alias("earlier")))
    match = same & (F.col("digest") == F.col("_digest")) & (F.col("_part") == F.col("_later"))
    if fits(seen, _BROADCAST_ROWS, _BROADCAST_BYTES):
        found = marked.join(F.broadcast(seen), match, "left")  # rows stay where they are
    else:
        # Written in order once more, as Spark may leave out a sort below a join.
        found = materialize(marked.join(seen, match, "left").repartition("_part").sortWithinPartitions("_part", "_place"))
    return found.drop("_conv", "_digest", "_later").withColumn("earlier", F.coalesce("earlier", F.lit(False)))


# Runs -----------------------------------------------------------------------------


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of a task by (part, conversation), a few at a time."""
    rows = (r for b in batches for at in range(0, b.num_rows, _SLICE) for r in b.slice(at, _SLICE).to_pylist())
    return groupby(rows, key=lambda r: (r["_part"], r["conv_id"]))


class Faults:
    """Counts of a run's faults, and what of its ends matters to the runs next to it."""

    def __init__(self):
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def take(self, r: dict) -> tuple[str, bool, bool]:
        """The row as the search sees it: initial, whether it must go, whether it is truncated."""
        blank = r["truncated"] is None
        duplicate = not blank and (r["earlier"] or r["digest"] in self.seen)
        truncated = not blank and not duplicate and r["truncated"]
        self.seen.add(r["digest"])
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        raw = r["role"][:1]
        if self.first is None:
            self.first = raw
        else:
            self.illegal += self.last + raw not in LEGAL
        self.last = raw
        if r["turn"] is not None:
            self.turns += r["turn"] != self.high
            self.low = r["turn"] if self.low is None else self.low
            self.high = r["turn"]
        return initial_of(r["role"]), blank or duplicate, truncated


_FACTS = "blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, low long, high long"
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "first", "last", "low", "high")


def _repaired(rows: Iterator[dict], faults: Faults, entry: int, exit_state: int | None) -> Iterator[tuple]:
    """Repaired rows of a run as they are settled; the last item is the cost."""
    search, emit, held = Survivors(entry), Emitter(entry), deque()
    for r in rows:
        held.append((r["role"], r["text"]))
        for letters in search.step(*faults.take(r)):
            yield from emit.rows(letters, *held.popleft())
    cost, _, rest, ending = search.finish(exit_state)
    for letters in rest:
        yield from emit.rows(letters, *held.popleft())
    yield from emit.rows(ending)
    yield cost


def _transfer(rows: Iterator[dict], faults: Faults) -> tuple[list, list]:
    """Costs and ranks from each state before a run to each state after it, 16 of each, row by row."""
    searches = [Survivors(s) for s in NEXT]
    for r in rows:
        seen = faults.take(r)
        for search in searches:
            search.step(*seen)
    costs = [None if s.cost[x] == _INF else int(s.cost[x]) for s in searches for x in NEXT]
    return costs, [s.rank[x] for s in searches for x in NEXT]


def _summaries(found: DataFrame) -> DataFrame:
    """One row per run: finished for whole conversations, else the costs and ranks of its states."""
    kind = found.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, _part long, crosses boolean, {_FACTS}, cost long, audit string, repaired_sha256 string, costs array<long>, ranks array<int>"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        for (part, conv), rows in _runs(batches):
            head = next(rows)
            rows = _chain(head, rows)
            faults = Faults()
            out = {"conv_id": conv, "_part": part, "crosses": head["crosses"]}
            if head["crosses"]:
                out["costs"], out["ranks"] = _transfer(rows, faults)
            else:
                digest = Digest()
                for item in _repaired(rows, faults, NOTHING, None):
                    if isinstance(item, tuple):
                        digest.add(*item)
                    else:
                        out["cost"] = item
                out["audit"], out["repaired_sha256"] = "".join(digest.edits), digest.sha.hexdigest()
            done.append(out | {name: getattr(faults, name) for name in _COUNTS})
            if len(done) == _SLICE:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return found.mapInArrow(run, schema)


def _chain(head: dict, rest: Iterator[dict]) -> Iterator[dict]:
    yield head
    yield from rest


def _meet(runs: DataFrame) -> DataFrame:
    """Per run of a crossing conversation the state before and after it; the last one says how to end.

    A group has a row per task that holds a part of the conversation.
    """
    kind = runs.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, _part long, entry int, exit int, ending string, {_FACTS}, cost long"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def solve(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["_part"])
        states, back = {NOTHING: (0, 0)}, []
        for r in rows:
            best: dict[int, tuple] = {}
            for before, (cost, rank) in states.items():
                for after in NEXT:
                    more = r["costs"][4 * before + after]
                    if more is not None:
                        way = (cost + more, rank, r["ranks"][4 * before + after], before)
                        best[after] = min(best.get(after, way), way)
            order = sorted(best, key=lambda s: best[s][1:3])
            back.append({s: best[s][3] for s in best})
            states = {s: (best[s][0], order.index(s)) for s in best}
        cost, _, ending, state = min((c + ENDINGS[s][0], k, ENDINGS[s][1], s) for s, (c, k) in states.items())
        facts = {name: sum(r[name] for r in rows) for name in ("blank", "duplicate", "truncated", "illegal", "turns")}
        for one, two in zip(rows, rows[1:]):
            facts["illegal"] += one["last"] + two["first"] not in LEGAL
        high = None
        for r in rows:
            facts["turns"] -= r["low"] is not None and r["low"] == high
            high = high if r["high"] is None else r["high"]
        lows = [r["low"] for r in rows if r["low"] is not None]
        facts |= {"low": lows[0] if lows else None, "high": high, "cost": cost, "first": rows[0]["first"], "last": rows[-1]["last"]}
        out = []
        for r, came in zip(rows[::-1], back[::-1]):
            out.append({"conv_id": r["conv_id"], "_part": r["_part"], "entry": came[state], "exit": state, "ending": ending} | facts)
            state, ending = came[state], ""
        return pa.Table.from_pylist(out, schema=arrow)

    return runs.groupBy("conv_id").applyInArrow(solve, schema)


def _edit_runs(found: DataFrame) -> DataFrame:
    """Repaired rows of runs with columns ``entry``, ``exit`` and ``ending``: conv_id, _part, _seq, edit, role, text."""
    kind = found.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, _part long, _seq long, edit string, role string, text string"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, conv), rows in _runs(batches):
            out, size, seq = [], 0, 0
            for item in _ended(next(rows), rows):
                out.append({"conv_id": conv, "_part": part, "_seq": seq, "edit": item[0], "role": item[1], "text": item[2]})
                seq += 1
                size += len(item[2] or "")
                if len(out) == _SLICE or size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return found.mapInArrow(run, schema)


def _ended(head: dict, rest: Iterator[dict]) -> Iterator[tuple]:
    """The repaired rows of a run, and behind a conversation's last run its ending."""
    for item in _repaired(_chain(head, rest), Faults(), head["entry"], head["exit"]):
        if isinstance(item, tuple):
            yield item
    if head["exit"] is not None:
        yield from Emitter(head["exit"]).rows(head["ending"])


def _digests(edited: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 from repaired rows, which pass in order and are not kept."""
    schema = f"conv_id {edited.schema['conv_id'].dataType.simpleString()}, audit string, repaired_sha256 string"
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for at in range(0, b.num_rows, _SLICE) for r in b.slice(at, _SLICE).to_pylist())
        for conv, own in groupby(rows, key=lambda r: r["conv_id"]):
            digest = Digest()
            for r in own:
                digest.add(r["edit"], r["role"], r["text"])
            row = {"conv_id": conv, "audit": "".join(digest.edits), "repaired_sha256": digest.sha.hexdigest()}
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return edited.repartition("conv_id").sortWithinPartitions("conv_id", "_part", "_seq").mapInArrow(run, schema)


# Results --------------------------------------------------------------------------

RESULTS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _prepared(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with faults, run summaries, and where the runs of crossing conversations meet; the last two written."""
    found = _with_earlier(_sorted_rows(rows))
    runs = materialize(_summaries(found))
    return found, runs, materialize(_meet(runs.filter("crosses")))


def _same_run(found: DataFrame, met: DataFrame, how: str) -> DataFrame:
    # One row per task and crossing conversation in it.
    states = met.select(F.col("conv_id").alias("_conv"), F.col("_part").alias("_at"), "entry", "exit", "ending")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_part") == F.col("_at"))
    return found.join(F.broadcast(states), same, how).drop("_conv", "_at")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults, cost, edits and digest of every conversation in ``rows(conv_id, turn, role, text)``."""
    found, runs, met = _prepared(rows)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    facts = ["conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = runs.filter("not crosses").select(*facts, "audit", "repaired_sha256")
    digests = _digests(_edit_runs(_same_run(found, met, "inner"))).withColumnRenamed("conv_id", "_conv")
    one = met.select(*facts).distinct()
    crossing = one.join(digests, one["conv_id"].eqNullSafe(digests["_conv"])).drop("_conv")
    return whole.unionByName(crossing)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """conv_id, position, edit, role and text of the repaired conversations in order; deleted rows have an edit only.

    Positions rise within a conversation and have gaps between tasks.
    """
    found, _, met = _prepared(rows)
    states = _same_run(found, met, "left").withColumn("entry", F.coalesce("entry", F.lit(NOTHING)))
    position = F.shiftleft("_part", 33).bitwiseOR(F.col("_seq")).alias("position")
    return _edit_runs(states).select("conv_id", position, "edit", "role", "text")


# Damage ---------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with repeatable faults by the crc32 of ``conv_id:turn`` modulo 20: dropped, emptied, without its
    stops, repeated, or of role user.  A NULL is one space, in the key too; a NULL id or turn stays NULL as such."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.filter(fault != 0).select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def with_all_ids(result: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for every conversation of ``rows``: those without a row in ``result`` have no faults and no edits."""
    every = rows.select(F.col("conv_id").alias("_id")).distinct()
    found = every.join(result, every["_id"].eqNullSafe(result["conv_id"]), "left")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    filled = [F.coalesce(F.col(c), nothing.get(c, F.lit(0))).alias(c) for c in RESULTS[1:]]
    return found.select(F.col("_id").alias("conv_id"), *filled)
