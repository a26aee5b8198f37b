"""Ranks of all columns of a table by one distributed sort.

Values of all columns are sorted together, by column and value; a row number
tells equal values apart, so a frequent value spreads over many tasks.  The
sorted values are written once and read as a stream.  Inside a task places are
counted from the run of its column.  Ties that do not lie in one task, and those
too long to wait for, are measured first: per task and column the ties at its
ends and those of ``_SLICE`` rows or more.  So a task holds fewer rows than that,
however many it reads.  One exchange then brings the ranks of a row together.
The number of exchanges does not depend on the number of columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assocframe.plans.materialize import materialize
from assocframe.roles import col

# Ties of so many rows in a task are measured before they are ranked.
_SLICE = 1 << 16


def column_ranks(complete: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """Average ranks ``r0, r1, ...`` and sizes of ties ``t0, t1, ...`` of each row, and the number of rows.

    ``columns`` are doubles without NULL.
    """
    numbered = complete.select(F.monotonically_increasing_id().alias("id"), F.array(*[col(c) + 0.0 for c in columns]).alias("_x"))
    long = numbered.select("id", F.posexplode("_x").alias("c", "value"))
    placed = materialize(long.orderBy("c", "value", "id").withColumn("part", F.spark_partition_id()))
    ends = materialize(placed.select("part", "c", "value").mapInArrow(_measured_ties, _TIES))
    runs = ends.groupBy("part", "c").agg(F.max(col("start") + col("n")).alias("n"))
    total = runs.filter("c = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # One row per task and column met in it.
    along = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("part", "c", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    # At most two more rows per task and column, and one per _SLICE values.
    ties = ends.join(before, ["part", "c"]).groupBy("c", "value").agg(F.min(col("before") + col("start")).alias("first"), F.sum("n").alias("rows"))
    known = placed.join(F.broadcast(before), ["part", "c"]).join(F.broadcast(ties), ["c", "value"], "left")
    ranked = known.select("id", "c", "value", "before", "first", "rows").mapInArrow(_rank_runs, _RANKS)
    picks = []
    for i in range(len(columns)):
        own = col("c") == i
        picks += [F.max(F.when(own, col("r"))).alias(f"r{i}"), F.max(F.when(own, col("t"))).alias(f"t{i}")]
    return ranked.groupBy("id").agg(*picks).drop("id"), total


_TIES = "part int, c int, value double, start long, n long"
_RANKS = "id long, c int, r double, t long"
_TIES_ARROW = pa.schema([("part", pa.int32()), ("c", pa.int32()), ("value", pa.float64()), ("start", pa.int64()), ("n", pa.int64())])
_RANKS_ARROW = pa.schema([("id", pa.int64()), ("c", pa.int32()), ("r", pa.float64()), ("t", pa.int64())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where the column changes."""
    for batch in batches:
        c = batch.column("c").to_numpy()
        cuts = [0, *(np.flatnonzero(c[1:] != c[:-1]) + 1).tolist(), len(c)]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)


def _tie_starts(x: np.ndarray) -> np.ndarray:
    return np.append(0, np.flatnonzero(x[1:] != x[:-1]) + 1)


def _ties_batch(part: int, c: int, *columns: np.ndarray) -> pa.RecordBatch:
    n = len(columns[0])
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, c, np.int32)), *map(pa.array, columns)], schema=_TIES_ARROW)


def _measured_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per column of a task its first and last tie and those of at least ``_SLICE`` rows: value, place in the run, rows."""
    run: tuple[int, int] | None = None
    open_tie: list[np.ndarray] = []  # value, start and rows of the one that may go on
    for piece in _pieces(batches):
        own = piece.column("part")[0].as_py(), piece.column("c")[0].as_py()
        if run is not None and run != own:
            yield _ties_batch(*run, *open_tie)
            open_tie = []
        run = own
        x = piece.column("value").to_numpy()
        cuts = _tie_starts(x)
        value, start, n = x[cuts], cuts.astype(np.int64), np.diff(np.append(cuts, len(x))).astype(np.int64)
        if open_tie:
            start += open_tie[1] + open_tie[2]
            if value[0] == open_tie[0][0]:
                start[0], n[0] = open_tie[1][0], n[0] + open_tie[2][0]
            else:
                value, start, n = (np.concatenate(both) for both in zip(open_tie, (value, start, n)))
        kept = np.flatnonzero((start[:-1] == 0) | (n[:-1] >= _SLICE))
        if len(kept):
            yield _ties_batch(*run, value[kept], start[kept], n[kept])
        open_tie = [value[-1:], start[-1:], n[-1:]]
    if run is not None:
        yield _ties_batch(*run, *open_tie)


def _rank_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Average ranks, batch by batch; ``first`` and ``rows`` of a tie are NULL unless it was measured, as the last of a run is."""
    c, at = None, 0
    held = ()
    for piece in _pieces(batches):
        if piece.column("c")[0].as_py() != c:
            c, at, held = piece.column("c")[0].as_py(), 0, ()
        now = [piece.column("value").to_numpy(), piece.column("id").to_numpy(), *(piece.column(k).fill_null(0).to_numpy() for k in ("first", "rows"))]
        x, ids, first, rows = (np.concatenate(both) for both in zip(held, now)) if held else now
        starts = _tie_starts(x)
        # A tie that was not measured may go on in the next batch.
        closed = len(x) if rows[-1] else int(starts[-1])
        counts = np.diff(np.append(starts, len(x)))
        measured = rows > 0
        first = np.where(measured, first, np.repeat(starts + (piece.column("before")[0].as_py() + at), counts))
        rows = np.where(measured, rows, np.repeat(counts, counts))
        r = first + (rows + 1) / 2
        if closed:
            columns = [ids[:closed], np.full(closed, c, np.int32), r[:closed], rows[:closed]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], schema=_RANKS_ARROW)
        at += closed
        # What is held is not measured.
        nothing = np.zeros(len(x) - closed, dtype=np.int64)
        held = (x[closed:].copy(), ids[closed:].copy(), nothing, nothing) if len(nothing) else ()
