"""Exact quantiles per key, found by position, in two scans.

1. One scan gives count, minimum, maximum and a mergeable KLL sketch per key.
   The sketch's values a little before and after each rank are brackets.
2. The brackets' ends cut the number line into segments.  The second scan counts
   the rows of each segment and, inside brackets, of each value.  Segment counts
   tell where each position lies; the values there are few.

A sketch may err, so a position can lie outside its bracket.  Its segment is then
scanned once more and the value found in it, so the answer is always exact; where
no position does, as almost always, that scan is left out at run time, because
the list of such segments is empty.  Both scans combine on the map side; one plan
fits tables of any size, and no job runs while it is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocframe.plans.joins import few_groups, group_join
from assocframe.plans.materialize import materialize
from assocframe.roles import col, to_double

_SKETCH_SIZE = 2048  # ranks err by about 0.0024 (99 of 100 times)
_MARGIN = 0.005  # of a rank, to both sides
_FINE = 1024  # cells of a segment, so that values are put in order cell by cell


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by..., column, value`` with one row per number; text that is no number is dropped."""
    picked = df.select(*[col(b) for b in by], *[to_double(col(c)).alias(c) for c in columns])
    long = picked.unpivot([col(b) for b in by], [col(c) for c in columns], "column", "value")
    return long.filter(col("value").isNotNull())


def quantile_array(
    values: DataFrame,
    keys: Sequence[str],
    qs: Sequence[float],
    bounded: bool = False,
) -> tuple[DataFrame, bool]:
    """``keys, n, min, max, q`` with ``q`` the array of linearly interpolated quantiles, and whether that table is small.

    ``bounded`` says the number of keys is bounded by the caller; else they are counted.
    """
    stats, few = order_statistics(values, keys, qs, bounded)
    picks = []
    for x in qs:
        place = F.lit(float(x)) * (col("n") - 1)
        low, high = F.floor(place), F.ceil(place)
        below, above = F.try_element_at("at", low), F.try_element_at("at", high)
        picks.append(
            F.when(low == high, below).otherwise((high - place) * below + (place - low) * above)
        )
    names = [c for c in stats.columns if c != "at"]
    return stats.select(*[col(c) for c in names], F.array(*picks).alias("q")), few


def middle_values(values: DataFrame, keys: Sequence[str], bounded: bool = False) -> DataFrame:
    """``keys, n, lower, upper``: the middle value, or the two middle values."""
    stats, _ = order_statistics(values, keys, [0.5], bounded)
    place = F.lit(0.5) * (col("n") - 1)
    return stats.select(
        *[col(k) for k in keys],
        "n",
        F.try_element_at("at", F.floor(place)).alias("lower"),
        F.try_element_at("at", F.ceil(place)).alias("upper"),
    )


def order_statistics(values: DataFrame, keys: Sequence[str], qs: Sequence[float], bounded: bool) -> tuple[DataFrame, bool]:
    """``keys, n, min, max, at`` where ``at`` maps the positions around each quantile to values; whether it is small."""
    keys, by = list(keys), [col(k) for k in keys]
    qs = sorted(set(float(q) for q in qs))
    numbers = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.kll_sketch_agg_double("value", F.lit(_SKETCH_SIZE)).alias("_sketch"),
    )
    # A sketch holds random choices, so the brackets, one row per key, are written once: a second
    # evaluation, or a task that runs again, would cut the number line elsewhere.
    numbers = materialize(_bracket_ends(numbers, qs))
    bounded = bounded or few_groups(numbers)
    ends = numbers.drop("n").withColumnsRenamed({"min": "_min", "max": "_max"})
    cut = _segments(group_join(values, ends, keys, bounded), keys, len(qs))
    # What the second scan found is written too: where positions lie is looked up in it several times.
    counted = materialize(
        cut.groupBy(*by, "_segment", F.expr("if(_inside, _fine, NULL)").alias("_fine"), F.expr("if(_inside, value, NULL)").alias("value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    wanted = materialize(_wanted(counted, numbers, keys, qs, bounded))
    found = _pick(counted, wanted.filter("_inside"), keys, bounded)
    missed = wanted.filter("not _inside")
    if not missed.isEmpty():
        again = group_join(cut, missed.select(*by, "_segment"), [*keys, "_segment"], bounded)
        again = again.groupBy(*by, "_segment", "_fine", "value").agg(F.count(F.lit(1)).alias("_rows"))
        found = found.unionByName(_pick(again, missed, keys, bounded))
    at = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_position", "value"))).alias("at"))
    return group_join(numbers.select(*by, "n", "min", "max"), at, keys, bounded), bounded


def _bracket_ends(numbers: DataFrame, qs: Sequence[float]) -> DataFrame:
    """A value before and one after each rank in place of the sketch: ``_low0, _high0, ...``.

    A key of fewer rows than a sketch holds is one bracket.
    """
    few = col("n") <= _SKETCH_SIZE
    ends = []
    for i, q in enumerate(qs):
        for name, rank, end in (("_low", max(0.0, q - _MARGIN), "min"), ("_high", min(1.0, q + _MARGIN), "max")):
            at = F.kll_sketch_get_quantile_double("_sketch", F.lit(rank))
            ends.append(F.when(few, col(end)).otherwise(at).alias(f"{name}{i}"))
    return numbers.select("*", *ends).drop("_sketch")


def _segments(values: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Each value with the number of its segment, whether a bracket covers it, and its cell in the segment.

    A bracket holds both of its ends.
    """
    places = range(n)
    starts = " + ".join(f"int(value >= _low{i})" for i in places)
    stops = " + ".join(f"int(value > _high{i})" for i in places)
    below = ", ".join(f"if(value >= _low{i}, _low{i}, NULL), if(value > _high{i}, _high{i}, NULL)" for i in places)
    above = ", ".join(f"if(value >= _low{i}, NULL, _low{i}), if(value > _high{i}, NULL, _high{i})" for i in places)
    marked = values.select(
        *[col(k) for k in keys], "value", F.expr(starts).alias("_starts"), F.expr(stops).alias("_stops"),
        F.expr(f"greatest(_min, {below})").alias("_below"), F.expr(f"least(_max, {above})").alias("_above"),
    )
    share = "(value - _below) / (_above - _below)"
    cell = f"if(_above > _below and _above - _below < double('infinity'), int(floor({share} * {_FINE})), 0)"
    return marked.select(
        *[col(k) for k in keys], "value", F.expr("_starts + _stops").alias("_segment"), F.expr("_starts > _stops").alias("_inside"),
        F.expr(cell).alias("_fine"),
    )


def _wanted(counted: DataFrame, numbers: DataFrame, keys: Sequence[str], qs: Sequence[float], bounded: bool) -> DataFrame:
    """The segments that hold wanted positions: ``keys, _segment, _inside, _from, _positions``."""
    by = [col(k) for k in keys]
    last = col("n") - 1
    positions = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(q * last), F.ceil(q * last)) for q in map(F.lit, qs)])))
    asked = numbers.select(*by, positions.alias("_asked"))
    # At most two segments per quantile, and one more.
    sums = counted.groupBy(*by, "_segment").agg(F.sum("_rows").alias("_rows"), F.count("_fine").alias("_cells"))
    along = Window.partitionBy(*by).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    placed = group_join(sums, asked, keys, bounded).withColumn("_from", F.coalesce(F.sum("_rows").over(along), F.lit(0)))
    held = F.filter("_asked", _within("_from"))
    return placed.select(*by, "_segment", (col("_cells") > 0).alias("_inside"), "_from", held.alias("_positions")).filter(F.size("_positions") > 0)


def _pick(counted: DataFrame, wanted: DataFrame, keys: Sequence[str], bounded: bool) -> DataFrame:
    """``keys, _position, value`` of the wanted positions, from counts of the values of their segments."""
    by, segment = [col(k) for k in keys], [*keys, "_segment"]
    cells = counted.groupBy(*by, "_segment", "_fine").agg(F.sum("_rows").alias("_rows"))
    along = Window.partitionBy(*by, "_segment").orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    placed = group_join(cells, wanted.drop("_inside"), segment, bounded).withColumn(
        "_from", col("_from") + F.coalesce(F.sum("_rows").over(along), F.lit(0))
    )
    held = F.filter("_positions", _within("_from"))
    located = placed.select(*by, "_segment", "_fine", "_from", held.alias("_positions")).filter(F.size("_positions") > 0)
    hit = group_join(counted, located, [*segment, "_fine"], bounded)
    order = Window.partitionBy(*by, "_segment", "_fine").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    first = hit.withColumn("_from", col("_from") + F.coalesce(F.sum("_rows").over(order), F.lit(0)))
    return first.select(*by, "value", F.explode(F.filter("_positions", _within("_from"))).alias("_position"))


def _within(first: str):
    """Whether the ``_rows`` rows from position ``first`` hold a position."""

    def holds(position: Column) -> Column:
        return (position >= col(first)) & (position < col(first) + col("_rows"))

    return holds
