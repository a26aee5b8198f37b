"""Global order without a one-task window.

A distributed sort puts rows into range partitions.  The sorted rows are
written to the checkpoint folder once, so that partition numbers are facts and
not something a second evaluation may choose differently; then only one count
per partition has to be summed up to turn local places into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocframe.plans.materialize import materialize
from assocframe.roles import col

_LOCAL = (1 << 33) - 1
_PIECE = 1_000_000


def _sorted_with_place(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    return materialize(placed).withColumn("_part", F.shiftright("_place", 33))


def _before(*partition: str) -> Window:
    return Window.partitionBy(*partition).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def _expand(df: DataFrame, first: str, copies: str, name: str) -> DataFrame:
    """``copies`` rows numbered from ``first``; many copies are cut into pieces over all tasks."""
    ends = col(copies) - 1
    pieces = df.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), ends, F.lit(_PIECE))))
    spread = pieces.repartition("_piece", first)
    place = F.explode(F.sequence(col("_piece"), F.least(ends, col("_piece") + F.lit(_PIECE - 1))))
    numbered = spread.withColumn("_copy", place).withColumn(name, col(first) + col("_copy"))
    return numbered.drop("_piece", "_copy", first, copies)


def global_row_number(
    df: DataFrame, order: Sequence[Column], name: str = "row_number", start: int = 1
) -> DataFrame:
    """Number all rows in ``order`` by one distributed sort, written once.

    Rows that tie in ``order`` are told apart by a hash, and rows that agree in
    all columns by where they were read, so neither ties nor copies end up in
    one sort partition; which copy gets which of their numbers does not matter.
    """
    columns = [col(c) for c in df.columns]
    told_apart = df.withColumn("_read", F.monotonically_increasing_id())
    placed = _sorted_with_place(told_apart, [*order, F.xxhash64(*columns).asc(), col("_read").asc()])
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per sort partition reaches the window over partitions.
    offsets = totals.select("_part", (F.coalesce(F.sum("_rows").over(_before()), F.lit(0)) + start).alias("_offset"))
    number = col("_offset") + col("_place").bitwiseAND(F.lit(_LOCAL))
    return placed.join(F.broadcast(offsets), "_part").select(*columns, number.alias(name))


def numbered_values(values: DataFrame, value: str, name: str = "i") -> DataFrame:
    """``name, value`` for every row, numbered from 1 in the order of ``value``.

    Only distinct values are sorted; equal values are laid out after that.
    """
    one = values.select(F.lit(0).alias("_key"), col(value))
    ranked = ranked_values(one, "_key", value).select(
        col(value), "n", (col("n_before") + 1).alias("_first")
    )
    return _expand(ranked, "_first", "n", name)


def ranked_values(values: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values per key with their count and place in the key's order.

    ``values`` is in long form.  Result: key, value, ``n`` rows with this value,
    ``n_before`` rows below it, ``idx`` distinct values below it.  Equal values
    are counted before anything is shuffled, so a hot value is one row here.
    """
    counted = values.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    placed = _sorted_with_place(counted, [col(key), col(value)])
    by_part = _before(key)
    # One row per sort partition and key met in it.
    offsets = (
        placed.groupBy("_part", key)
        .agg(F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_distinct"))
        .select(
            "_part",
            key,
            F.coalesce(F.sum("_rows").over(by_part), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_distinct").over(by_part), F.lit(0)).alias("_distinct_before"),
        )
    )
    local = Window.partitionBy("_part", key).orderBy("_place")
    return (
        placed.withColumn(
            "_n_local",
            F.coalesce(
                F.sum("n").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn("_idx_local", F.row_number().over(local) - 1)
        .join(F.broadcast(offsets), ["_part", key])
        .select(
            key,
            value,
            "n",
            (col("_rows_before") + col("_n_local")).alias("n_before"),
            (col("_distinct_before") + col("_idx_local")).alias("idx"),
        )
    )
