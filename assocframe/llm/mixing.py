"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source whose target is r times its size takes every document floor(r) or
floor(r) + 1 times.  The fractions are rounded by the pivotal method: two
documents are paired, and words are moved from one's copy probability to the
other's at random until one of them is 0 or 1.  Moving words, not
probabilities, keeps the expected words of a source constant at every step, so
what a source takes differs from its target by half a document at most.

Pairs meet in a reduction tree.  Documents of a source are dealt into blocks of
about FAN; a block is folded into decisions and one residual document; residuals
of FAN blocks form the next block, until a source has one.  A level is one
shuffle of a row per block, a block never holds more than a few times FAN rows,
and random draws are hashes of the pair, so reruns agree.

Defined results: a NULL text has size 0 and takes 0 words; a NULL source is a
source of its own, last in order; NULL ids are documents like others; repeated
rows (same id, source and text) are counted: of n repeats with fraction p,
floor(n * p) are taken once more outright and one is rounded like any document,
so their copies differ by one at most; which repeats have more goes by a hash of
their other columns.  Very long texts are only counted.  Sources of size 0 have
target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocframe.llm.common import WORD
from assocframe.plans.materialize import materialize

WEIGHTS = (5, 2, 1)
LARGEST_FACTOR = 3
FAN = 64
#: A table of targets with at most so many rows (one per source) is broadcast after it was counted.
BROADCAST_SOURCES = 20_000

KEY = ("doc_id", "source", "size", "text_hash")
_GOALS = ("source_size", "target", "rows")
#: Repeats are ranked by hash in so many ranges, so that no window holds all of one row's.
_RANGE_BITS = 10
_PIECE = 4096


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and text_hash of every document."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", words.alias("size"), F.xxhash64("text").alias("text_hash"))


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, factor: int = LARGEST_FACTOR) -> DataFrame:
    """Adds ``target`` to a table of (source, source_size, ...), one row per source.

    Sources share all words by weight, the weights repeating in code point order
    (a string order of UTF-8 bytes, as Spark's is), NULL last.  A target stops
    at ``factor`` times the source; the excess is shared again by weight.  With
    sources sorted by cap / weight, those that stop come first, and the level of
    the rest follows from running sums.
    """
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weighed = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank - 1) % len(weights) + 1))
    capped = weighed.withColumn("cap", F.col("source_size") * factor)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rest = lambda c, total: F.sum(total).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0))
    shared = (
        capped.withColumn("place", F.row_number().over(order))
        .withColumn("words_left", rest("cap", "source_size"))
        .withColumn("weight_left", rest("weight", "weight"))
        .withColumn("fits", F.col("words_left") * F.col("weight") <= F.col("cap") * F.col("weight_left"))
    )
    first = F.min(F.when(F.col("fits"), F.struct("place", "words_left", "weight_left"))).over(everything)
    level = F.col("first.words_left") / F.col("first.weight_left")
    target = F.when(F.col("place") < F.col("first.place"), F.col("cap").cast("double")).otherwise(F.col("weight") * level)
    return shared.withColumn("first", first).select(*by_source.columns, target.alias("target"))


def decisions(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, factor: int = LARGEST_FACTOR) -> DataFrame:
    """KEY, source_size, target, rows, copies and extra, one row per distinct document of ``sized``.

    Each of its ``rows`` is taken ``copies`` times, and ``extra`` of them once more.
    """
    units = materialize(sized.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")))
    words = F.coalesce(F.sum(F.col("size") * F.col("rows")), F.lit(0)).alias("source_size")
    count = F.count(F.when(F.col("size") > 0, 1)).alias("units")
    by_source = units.groupBy("source").agg(words, count)
    goals = materialize(targets(by_source, weights, factor))
    n_sources, largest = goals.agg(F.count(F.lit(1)), F.coalesce(F.max("units"), F.lit(0))).first()
    aimed = goals.select(F.col("source").alias("_source"), "source_size", "target", "units")
    if n_sources <= BROADCAST_SOURCES:
        aimed = F.broadcast(aimed)
    joined = units.join(aimed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.nullif("source_size", F.lit(0))).otherwise(F.lit(0.0))
    ready = (
        joined.withColumn("ratio", F.least(ratio, F.lit(float(factor))))
        .withColumn("base", F.floor("ratio"))
        .withColumn("expected", (F.col("ratio") - F.col("base")) * F.col("rows"))
        .withColumn("whole", F.floor("expected"))
        .withColumn("p", F.col("expected") - F.col("whole"))
        .drop("ratio", "expected")
    )
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    fixed = ready.filter(~fractional).select(*KEY, *_GOALS, F.col("base").alias("copies"), F.col("whole").alias("extra"))
    return fixed.unionByName(_rounded(ready.filter(fractional), int(largest)))


# The tree -------------------------------------------------------------------------


def _rounded(units: DataFrame, largest: int) -> DataFrame:
    mass = F.col("size").cast("double")  # of the one repeat that is not decided yet
    unit = F.struct(
        F.xxhash64("doc_id", "source", "text_hash").alias("draw"),
        *[F.col(c) for c in KEY],
        *[*_GOALS, "base", "whole", mass.alias("mass"), "p"],
    )
    blocks = max(1, -(-largest // FAN))
    own = F.greatest(F.lit(1), F.ceil(F.col("units") / FAN))
    block = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("block")), own)
    level = units.select("source", block.alias("block"), unit.alias("unit"))
    decided = []
    while True:
        groups = level.groupBy("source", "block").agg(F.array_sort(F.collect_list("unit")).alias("met"))
        folded = materialize(groups.select("source", "block", _fold(F.col("met"), level.schema["unit"].dataType.simpleString())))
        decided.append(folded.select(F.inline("state.done")))
        if blocks == 1:
            break
        blocks = -(-blocks // FAN)
        level = folded.select("source", F.floor(F.col("block") / FAN).alias("block"), F.col("state.held").alias("unit"))
    last = folded.select("state.held.*")
    # The one residual document of a source goes to the nearer side: at most half of it is off the target.
    decided.append(last.withColumn("taken", (F.col("p") >= 0.5).cast("int")))
    out = None
    for part in decided:
        rows = part.select(*KEY, *_GOALS, F.col("base").alias("copies"), (F.col("whole") + F.col("taken")).alias("extra"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _uniform(a: Column, b: Column) -> Column:
    """A number in [0, 1) drawn by two hashes."""
    return F.shiftrightunsigned(F.xxhash64(a, b, F.lit("pivot")), 11) / F.lit(float(1 << 53))


def _fold(met: Column, unit_type: str) -> Column:
    """Folds units into ``state(held, done)``: pairs what is held with the next unit until one is integral."""
    done_type = "array<" + unit_type[:-1] + ",taken:int>>"

    def with_p(u: Column, p: Column) -> Column:
        return u.withField("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))

    def meet(a: Column, b: Column) -> Column:
        """(held, out): the unit that stays fractional and the decided one, with ``taken``."""
        a_up, a_down = (1 - a["p"]) * a["mass"], a["p"] * a["mass"]
        b_up, b_down = (1 - b["p"]) * b["mass"], b["p"] * b["mass"]
        gain, loss = F.least(a_up, b_down), F.least(a_down, b_up)
        # The expected move is gain * loss - loss * gain = 0 words.
        a_gains = _uniform(a["draw"], b["draw"]) * (gain + loss) < loss
        leaves = lambda out, taken, held, p: F.struct(
            with_p(held, p).alias("held"), out.withField("taken", F.lit(taken)).alias("out")
        )
        return F.when(
            a_gains,
            F.when(a_up <= b_down, leaves(a, 1, b, b["p"] - a_up / b["mass"])).otherwise(
                leaves(b, 0, a, a["p"] + b_down / a["mass"])
            ),
        ).otherwise(
            F.when(a_down <= b_up, leaves(a, 0, b, b["p"] + a_down / b["mass"])).otherwise(
                leaves(b, 1, a, a["p"] - b_up / a["mass"])
            )
        )

    def step(state: Column, unit: Column) -> Column:
        pair = meet(state["held"], unit)
        return F.struct(pair["held"].alias("held"), F.concat(state["done"], F.array(pair["out"])).alias("done"))

    start = F.struct(F.element_at(met, 1).alias("held"), F.array().cast(done_type).alias("done"))
    return F.aggregate(F.slice(met, 2, F.greatest(F.size(met) - 1, F.lit(0))), start, step).alias("state")


def mix(sized: DataFrame, decided: DataFrame) -> DataFrame:
    """Each row of ``sized`` (it may hold more columns than KEY) with its source_size, target and copies."""
    rows = sized.select(F.struct(*[F.col(f"`{c}`") for c in sized.columns]).alias("_row"))
    same = F.lit(True)
    for k in KEY:
        same = same & F.col(f"_row.{k}").eqNullSafe(F.col(k))
    return _copies_of_rows(rows.join(decided, same)).select("_row.*", "source_size", "target", "copies")


def take_mixed(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keys = [F.col("doc_id").alias("_id"), F.col("source").alias("_from"), F.xxhash64("text").alias("_hash")]
    chosen = decisions(materialize(sizes(docs))).filter("copies > 0 or extra > 0")
    same = (
        F.col("_id").eqNullSafe(F.col("doc_id"))
        & F.col("_from").eqNullSafe(F.col("source"))
        & (F.col("_hash") == F.col("text_hash"))
    )
    rows = docs.select(F.struct(*columns).alias("_row"), *keys)
    taken = _copies_of_rows(rows.join(chosen, same).drop("_id", "_from", "_hash")).filter("copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def _copies_of_rows(joined: DataFrame) -> DataFrame:
    """``_row, source_size, target, copies`` from rows joined with their decisions.

    Only repeats of which some, but not all, are taken once more are told apart:
    equal ones are counted, ranked by hash, and laid out again in pieces.
    """
    out = ["_row", "source_size", "target", "copies"]
    alike = (F.col("extra") == 0) | (F.col("extra") == F.col("rows"))
    more = F.when(F.col("extra") > 0, 1).otherwise(0)
    settled = joined.filter(alike).withColumn("copies", F.col("copies") + more).select(*out)

    goals = [*KEY, *_GOALS, "copies", "extra"]
    parted = joined.filter(~alike).withColumn("_hash", F.xxhash64(F.to_json("_row")))
    counted = parted.groupBy(*goals, "_hash").agg(F.any_value("_row").alias("_row"), F.count(F.lit(1)).alias("n"))
    ranged = counted.withColumn("_range", F.shiftright("_hash", 64 - _RANGE_BITS))
    ranges = ranged.groupBy(*KEY, "_range").agg(F.sum("n").alias("n"))
    before = lambda *order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before("_range").partitionBy(*KEY)), F.lit(0))
    starts = ranges.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("_range").alias("_in"), earlier.alias("start"))
    same = F.col("_range") == F.col("_in")
    for k in KEY:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    own = F.coalesce(F.sum("n").over(before("_hash").partitionBy(*KEY, "_range")), F.lit(0))
    placed = ranged.withColumn("own", own).join(starts, same)
    left = F.col("extra") - F.col("start") - F.col("own")
    placed = placed.withColumn("up", F.greatest(F.lit(0), F.least(left, F.col("n"))))
    kinds = F.array(
        F.struct((F.col("copies") + 1).alias("copies"), F.col("up").alias("n")),
        F.struct(F.col("copies").alias("copies"), (F.col("n") - F.col("up")).alias("n")),
    )
    shares = placed.select("_row", "source_size", "target", F.inline(kinds)).filter("n > 0")
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / _PIECE))).alias("piece")
    cut = shares.select(*out, "n", pieces).repartition("piece", F.xxhash64("_row.doc_id"))
    length = F.least(F.lit(_PIECE), F.col("n") - F.col("piece") * _PIECE).cast("int")
    told = cut.select(*out, F.explode(F.sequence(F.lit(1), length)).alias("_repeat")).select(*out)
    return settled.unionByName(told)
