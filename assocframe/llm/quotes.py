"""Quotation linking: who answers whom, from the passages that messages quote.

Each line of a message has a quote level, the number of ``>`` marks before it.
Neighbouring lines of one level form a passage.  A passage in normal form (lower
case, single spaces, so line breaks and wrapping do not matter) is hashed and
joined to the messages whose own words hold it: as any lines in a row (blank
ones left out), as a paragraph or as a whole.  Of lines in a row, messages offer
only numbers of lines that some quote has.  A passage of several paragraphs that
nobody holds is looked for paragraph by paragraph; its origin is the latest of
theirs.  A message answers the latest message that its quotes of the outermost
level come from; chains of answers give threads, ordered by reply, whose texts
keep no quotes.  A part of a line is no passage, nor are lines of several
messages that stand together.

Within a conversation the earliest message that holds a passage counts as its
origin, or else the earliest of all conversations.  An origin always comes
before the message that quotes it, in the order of (conv_id, turn), so threads
have no cycles.  Origins are the smallest per passage, taken before any join, so
a passage that very many messages hold or quote is one row on the origins' side.

Defined results: a NULL or empty text is an empty message; NULL conv_id or turn
are keys like others, smaller than all numbers; rows that repeat a key are
messages each and share the answers of that key; quotes that nobody wrote, and
empty ones, link to nothing; an empty table gives an empty result; other columns
are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.llm.common import map_rows, mix64
from assocframe.plans.materialize import materialize

_MARKS = re.compile(r"(?:[ \t]*>)+")
_BLANK = re.compile(r"\n\s*\n")

# An odd number and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: How a part of a quoted passage is looked for.
WHOLE, PARAGRAPH = range(2)


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """A message's own text, and its quoted passages with their levels, in order."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        level = marks.group().count(">") if marks else 0
        if level == 0:
            own.append(line)
        elif level == before:
            passages[-1][1].append(line[marks.end() :])
        else:
            passages.append((level, [line[marks.end() :]]))
        before = level
    return "\n".join(own).strip(), [(level, "\n".join(lines)) for level, lines in passages]


def normal_form(passage: str) -> str:
    return " ".join(passage.lower().split())


class Words:
    """Words whose runs are hashed by one subtraction each: sums of word hashes times rising powers of an odd base, modulo 2 ** 64."""

    def __init__(self, words: list[str]) -> None:
        hashes = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words]
        powers = np.ones((2, len(words) + 1), dtype=np.uint64)
        powers[:, 1:] = np.array([[_BASE], [_INVERSE]], dtype=np.uint64)
        powers, self.back = np.multiply.accumulate(powers, axis=1)
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(np.array(hashes, dtype=np.uint64) * powers[:-1], out=self.sums[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> list[int]:
        """Signed hashes of the words from each start to its end."""
        return mix64((self.sums[end] - self.sums[start]) * self.back[start]).view(np.int64).tolist()


def digest(passage: str) -> int | None:
    """A signed 64-bit hash of a passage in normal form; none for an empty one."""
    words = passage.lower().split()
    return Words(words).runs(np.array([0]), np.array([len(words)]))[0] if words else None


def line_forms(passage: str) -> list[str]:
    return [form for form in map(normal_form, passage.split("\n")) if form]


def own_digests(own: str, counts: Iterable[int] | None = None) -> set[int]:
    """Hashes of what others may quote: the text, its paragraphs and all lines in a row, of the given counts or of any."""
    found = {d for d in map(digest, [own, *_BLANK.split(own)]) if d is not None}
    lines = [form.split(" ") for form in line_forms(own)]
    words = Words([word for line in lines for word in line])
    ends = np.cumsum([0, *map(len, lines)])
    for n in range(1, len(lines) + 1) if counts is None else counts:
        if 0 < n <= len(lines):
            found.update(words.runs(ends[:-n], ends[n:]))
    return found


def quote_parts(passage: str) -> list[tuple[int, int, int, int]]:
    """(place, kind, lines, hash) of all parts that a quoted passage is looked for by."""
    whole = digest(passage)
    if whole is None:
        return []
    parts = [(0, WHOLE, len(line_forms(passage)), whole)]
    paragraphs = [p for p in _BLANK.split(passage) if normal_form(p)]
    if len(paragraphs) > 1:
        parts += [(k, PARAGRAPH, len(line_forms(p)), digest(p)) for k, p in enumerate(paragraphs)]
    return parts


# Spark ----------------------------------------------------------------------------

_PARSED = (
    "text string, quotes array<struct<level: int, passage: bigint, "
    "parts: array<struct<place: int, kind: int, lines: int, part: bigint>>>>"
)


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotes, and quotes with their parts of every message."""
    kinds = {c: messages.schema[c].dataType.simpleString() for c in ("conv_id", "turn", "role")}

    def run(rows: list[dict]) -> dict[str, list]:
        found = [parse(r["text"]) for r in rows]
        out: dict[str, list] = {c: [r[c] for r in rows] for c in kinds}
        out["text"] = [own for own, _ in found]
        names = ("place", "kind", "lines", "part")
        parts = lambda p: [dict(zip(names, part, strict=True)) for part in quote_parts(p)]
        out["quotes"] = [[{"level": n, "passage": digest(p), "parts": parts(p)} for n, p in q] for _, q in found]
        return out

    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", " + _PARSED
    return map_rows(messages.select(*kinds, "text"), run, schema)


def held(messages: DataFrame, counts: list[int]) -> DataFrame:
    """conv_id, turn and part: what others may quote of every message, of lines in a row these counts only."""

    def run(rows: list[dict]) -> dict[str, list]:
        out: dict[str, list] = {c: [r[c] for r in rows] for c in ("conv_id", "turn")}
        return out | {"own": [sorted(own_digests(parse(r["text"])[0], counts)) for r in rows]}

    kinds = ", ".join(f"{c} {messages.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn"))
    rows = map_rows(messages.select("conv_id", "turn", "text"), run, f"{kinds}, own array<bigint>")
    return rows.select("conv_id", "turn", F.explode("own").alias("part"))


def quote_links(messages: DataFrame, read: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage, origin_conv and origin_turn of every quote of ``messages`` (``read`` by ``parsed``) that has an origin."""
    found = read.select("conv_id", "turn", F.inline("quotes")).filter("passage is not null")
    quotes = materialize(found.select("conv_id", "turn", "level", "passage", F.inline("parts")).distinct())
    wanted = quotes.select("part").distinct()
    # One number for each count of lines that occurs.
    counts = [r["lines"] for r in quotes.select("lines").distinct().collect()]
    place = F.struct(F.col("conv_id").alias("conv"), F.col("turn").alias("turn"))
    # Only parts that are quoted somewhere go on; each is reduced to its first holder per conversation.
    near = held(messages, counts).join(wanted, "part", "left_semi").groupBy("conv_id", "part").agg(F.min(place).alias("near"))
    far = near.groupBy("part").agg(F.min("near").alias("far"))
    inside = near.withColumnsRenamed({"conv_id": "_conv", "part": "_part"})
    same = (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    joined = quotes.join(inside, same, "left").join(far, "part", "left")
    origin = F.when(F.col("near") < place, F.col("near")).when(F.col("far") < place, F.col("far"))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("origin"))
    key = ["conv_id", "turn", "level", "passage"]
    found = F.coalesce(F.max(of(WHOLE)), F.max(of(PARAGRAPH))).alias("origin")
    linked = joined.withColumn("origin", origin).groupBy(*key).agg(found).filter("origin is not null")
    return linked.select(*key, F.col("origin.conv").alias("origin_conv"), F.col("origin.turn").alias("origin_turn"))


def _answers(links: DataFrame) -> DataFrame:
    """One row per answering key: key, parent (both structs)."""
    outermost = links.groupBy("conv_id", "turn").agg(
        F.max(F.struct((-F.col("level")).alias("outer"), "origin_conv", "origin_turn")).alias("best")
    )
    key = F.struct(F.col("conv_id").alias("conv"), F.col("turn").alias("turn"))
    parent = F.struct(F.col("best.origin_conv").alias("conv"), F.col("best.origin_turn").alias("turn"))
    return outermost.select(key.alias("key"), parent.alias("parent"))


def threads(links: DataFrame) -> DataFrame:
    """key, parent, root and depth of every message that answers another; roots answer nobody.

    Each round doubles the length of the chains that are followed.
    """
    now = materialize(_answers(links).select("key", "parent", F.col("parent").alias("root"), F.lit(1).alias("depth")))
    while True:
        above = now.select(F.col("key").alias("_key"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        joined = now.join(above, F.col("root").eqNullSafe(F.col("_key")), "left")
        if joined.filter("_depth is not null").isEmpty():
            return now
        now = materialize(
            joined.select(
                "key", "parent",
                F.when(F.col("_depth").isNull(), F.col("root")).otherwise(F.col("_root")).alias("root"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            )
        )


def reply_conversations(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, with what it answers and its place in a thread.

    Sorting by thread_conv, thread_turn, depth, conv_id and turn gives the threads in reply order.
    """
    read = materialize(parsed(messages))
    links = materialize(quote_links(messages, read))
    counted = links.groupBy("conv_id", "turn").agg(F.count_distinct("level", "passage").alias("n_linked"))
    known = threads(links).join(
        counted,
        F.col("key.conv").eqNullSafe(F.col("conv_id")) & F.col("key.turn").eqNullSafe(F.col("turn")),
    ).select("key", "parent", "root", "depth", "n_linked")
    key = F.struct(F.col("conv_id").alias("conv"), F.col("turn").alias("turn"))
    joined = read.withColumn("_own", key).join(known, F.col("_own").eqNullSafe(F.col("key")), "left")
    root = F.when(F.col("depth").isNull(), F.col("_own")).otherwise(F.col("root"))
    levels = F.transform("quotes", lambda q: q["level"])
    return joined.select(
        "conv_id", "turn", "role", "text",
        F.size("quotes").cast("bigint").alias("n_quotes"),
        F.coalesce(F.array_max(levels), F.lit(0)).alias("quote_depth"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        F.col("parent.conv").alias("answers_conv"),
        F.col("parent.turn").alias("answers_turn"),
        root["conv"].alias("thread_conv"),
        root["turn"].alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )
