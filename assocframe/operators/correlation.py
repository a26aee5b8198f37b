"""Pearson, Spearman and Kendall correlation, all with list-wise deletion.

A correlation is a long table ``col_a, col_b, r`` with one row per unordered
pair of columns; ``correlation_matrix`` gives the square form.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.functions.scalars import round_even
from assocframe.operators.filters import drop_incomplete
from assocframe.plans.materialize import materialize
from assocframe.plans.moments import pearson_of_columns
from assocframe.plans.ranks import column_ranks
from assocframe.roles import col, numeric_columns, to_double

_PAIRS_IN_AGGREGATES = 60
# Ranges of an axis of the Kendall count.
_RANGE_ROWS = 50_000
_LEAST_RANGES, _MOST_RANGES = 16, 2_048


def correlatable_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns with more than one distinct value; one pass of minima and maxima."""
    names = numeric_columns(df) if columns is None else list(columns)
    if not names:
        return []
    ends = df.agg(
        *[F.min(to_double(col(c))).alias(f"lo{i}") for i, c in enumerate(names)],
        *[F.max(to_double(col(c))).alias(f"hi{i}") for i, c in enumerate(names)],
    ).first()
    return [
        c for i, c in enumerate(names)
        if ends[f"lo{i}"] is not None and ends[f"lo{i}"] != ends[f"hi{i}"]
    ]


def variance_topk(df: DataFrame, k: int = 20, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` numeric columns of greatest sample variance: ``column, variance``."""
    names = numeric_columns(df) if columns is None else list(columns)
    wide = df.agg(*[F.var_samp(to_double(col(c))).alias(c) for c in names])
    long = wide.unpivot([], [col(c) for c in names], "column", "variance")
    return long.orderBy(F.desc_nulls_last("variance"), "column").limit(k)


def top_variance_columns(df: DataFrame, k: int = 20) -> list[str]:
    return [r["column"] for r in variance_topk(df, k).collect()]


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return drop_incomplete(df.select(*[to_double(col(c)).alias(c) for c in columns]), columns)


def _pairs_to_rows(wide: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(rows))


def _no_pairs(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double")


def _pearson(complete: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One scan: JVM aggregates of a few pairs, or blocks of products of all columns."""
    pairs = list(combinations(columns, 2))
    if len(pairs) > _PAIRS_IN_AGGREGATES:
        return pearson_of_columns(complete, columns)
    spread = {c: f"s{i}" for i, c in enumerate(columns)}
    sums = complete.agg(
        *[F.stddev_pop(col(c)).alias(s) for c, s in spread.items()],
        *[F.covar_pop(col(a), col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)],
    )
    # corr() itself fails on a constant column under ANSI rules.
    r = [
        (col(f"c{i}") / F.nullif(col(spread[a]) * col(spread[b]), F.lit(0.0))).alias(f"r{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    return _pairs_to_rows(sums.select(*r), pairs)


def _spearman(complete: DataFrame, columns: Sequence[str]) -> DataFrame:
    ranked, _ = column_ranks(complete, columns)
    return _pearson(ranked.select(*[col(f"r{i}").alias(c) for i, c in enumerate(columns)]), columns)


def _kendall(complete: DataFrame, columns: Sequence[str], named: Sequence[tuple[str, str]] | None) -> DataFrame:
    """Kendall tau-b without comparing rows with rows.

    Both axes of a pair of columns are cut into ranges of ranks.  Row pairs that
    differ in both ranges are counted from a two-dimensional histogram of the
    ranges.  Those that share a range of one axis are counted inside it, by
    merging: a range holds about ``_RANGE_ROWS`` rows, and a value so frequent
    that it fills a range of its own ties with all in it and adds nothing.  Those
    that share both ranges are met twice and taken off once.  A row travels at
    most twice per pair of columns.
    """
    ranked, total = column_ranks(complete, columns)
    ranked = materialize(ranked)
    at = {c: i for i, c in enumerate(columns)}
    pairs = [(at[a], at[b]) for a, b in (combinations(columns, 2) if named is None else named)]
    ranges = int(min(_MOST_RANGES, max(_LEAST_RANGES, -(-total // _RANGE_ROWS))))
    number = "decimal(38,0)"  # counts of row pairs outgrow a long at 3e9 rows
    width = max(total, 1) / ranges
    frequent = 2 * width

    def range_of(i: int) -> Column:
        return F.least(F.floor((col(f"r{i}") - 1) / F.lit(width)), F.lit(ranges - 1)).cast("int")

    cells = F.array(*[
        F.struct(F.lit(k).alias("pair"), range_of(a).alias("i"), range_of(b).alias("j"), col(f"r{a}").alias("x"), col(f"r{b}").alias("y"),
                 (col(f"t{a}") < frequent).alias("x_rare"), (col(f"t{b}") < frequent).alias("y_rare"))
        for k, (a, b) in enumerate(pairs)
    ])
    placed = ranked.select(F.inline(cells))
    between = placed.groupBy("pair", "i", "j").agg(F.count(F.lit(1)).alias("n")).groupBy("pair").applyInArrow(_between_ranges, _SCORES)
    sides = F.array(
        F.struct(F.lit(0).alias("axis"), col("i").alias("span"), col("j").alias("cell"), col("x_rare").alias("rare")),
        F.struct(F.lit(1).alias("axis"), col("j").alias("span"), col("i").alias("cell"), col("y_rare").alias("rare")),
    )
    own = placed.select("pair", "x", "y", F.inline(sides)).filter("rare").drop("rare")
    within = own.groupBy("pair", "axis", "span").applyInArrow(_within_range, _SCORES)
    score = between.unionByName(within).groupBy("pair").agg(F.sum("score").cast("double").alias("s"))
    ties = ranked.agg(*[F.coalesce(F.sum((col(f"t{i}") - 1).cast(number)) / 2, F.lit(0)).cast("double").alias(f"t{i}") for i in range(len(columns))])
    all_pairs = total * (total - 1) / 2.0
    free = [F.lit(all_pairs) - col(f"t{i}") for i in range(len(columns))]
    sizes = F.array(*[
        F.struct(F.lit(k).alias("pair"), F.lit(columns[a]).alias("col_a"), F.lit(columns[b]).alias("col_b"), (F.sqrt(free[a]) * F.sqrt(free[b])).alias("size"))
        for k, (a, b) in enumerate(pairs)
    ])
    tau = col("s") / F.nullif(col("size"), F.lit(0.0))
    return ties.select(F.inline(sizes)).join(score, "pair", "left").select("col_a", "col_b", tau.alias("r"))


_SCORES = "pair int, score decimal(38,0)"


def _score_row(pair: int, score: int) -> pa.Table:
    return pa.table({"pair": pa.array([pair], pa.int32()), "score": pa.array([Decimal(score)], pa.decimal128(38, 0))})


def _between_ranges(table: pa.Table) -> pa.Table:
    """Agreeing less disagreeing row pairs that differ in both ranges, from the counts of (i, j)."""
    i, j, n = (table[c].to_numpy() for c in ("i", "j", "n"))
    counts = np.zeros((i.max() + 1, j.max() + 1), dtype=np.int64)
    counts[i, j] = n
    before = np.cumsum(counts, axis=0) - counts  # rows of smaller i, by j
    below = np.cumsum(before, axis=1)
    balance = (below - before) - (below[:, -1:] - below)
    # Python's whole numbers: a product of two counts may outgrow 64 bits.
    score = sum(int(a) * int(b) for a, b in zip(n, balance[i, j]))
    return _score_row(table["pair"][0].as_py(), score)


def _within_range(table: pa.Table) -> pa.Table:
    """Agreeing less disagreeing row pairs of one range; those of one cell count on the second axis only."""
    x, y, cell = (table[c].to_numpy() for c in ("x", "y", "cell"))
    score = agreement(x, y, np.zeros(len(x), dtype=np.int64))
    if table["axis"][0].as_py() == 0:
        score -= agreement(x, y, cell.astype(np.int64))
    return _score_row(table["pair"][0].as_py(), score)


def agreement(x: np.ndarray, y: np.ndarray, group: np.ndarray) -> int:
    """Agreeing less disagreeing pairs of rows of equal ``group``; pairs that tie in x or y are neither."""
    x, y = (np.unique(v, return_inverse=True)[1].astype(np.int64) for v in (x, y))
    order = np.lexsort((y, x, group))
    x, y, group = x[order], y[order], group[order]
    bits = max(1, int(y.max()).bit_length()) if len(y) else 1
    key = (group << bits) | y
    free = _tied(group) - _tied((group << 32) | x) - _tied(np.sort(key)) + _tied((group << 32) | x, y)
    return free - 2 * inversions(key, bits)


def _tied(*keys: np.ndarray) -> int:
    """Pairs of rows that are equal in all keys, given in order."""
    change = np.zeros(len(keys[0]), dtype=bool)
    change[:1] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    counts = np.diff(np.append(np.flatnonzero(change), len(change)))
    return int((counts * (counts - 1) // 2).sum())


def inversions(key: np.ndarray, bits: int) -> int:
    """Pairs out of order in the low ``bits`` of ``key``, whose higher bits are in order and tell groups apart.

    Rows are split by one bit after the other, keeping their order: a pair out
    of order is counted where its bits first differ.
    """
    total = 0
    for bit in range(bits - 1, -1, -1):
        head = key >> (bit + 1)
        ones = (key >> bit) & 1
        upto = np.cumsum(ones)
        first = np.append(True, head[1:] != head[:-1]) if len(head) else np.zeros(0, bool)
        starts = np.flatnonzero(first)
        base = np.repeat((upto - ones)[starts], np.diff(np.append(starts, len(head))))
        total += int(((upto - base) * (1 - ones)).sum())
        key = key[np.argsort(key >> bit, kind="stable")]
    return total


def correlation(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "pearson",
    pairs: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """``col_a, col_b, r`` of all column pairs, or of the named ones, over rows complete in all columns."""
    names = correlatable_columns(df) if columns is None else list(columns)
    if len(names) < 2:
        return _no_pairs(df)
    complete = _complete(df, names)
    if method == "kendall":
        return _kendall(complete, names, pairs)
    if method not in ("pearson", "spearman"):
        raise ValueError("method must be 'pearson', 'spearman' or 'kendall'")
    found = _pearson(complete, names) if method == "pearson" else _spearman(complete, names)
    if pairs is None:
        return found
    own = F.lit(False)
    for a, b in pairs:
        own = own | ((col("col_a") == a) & (col("col_b") == b))
    return found.filter(own)


def correlation_matrix(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All ordered pairs, the diagonal being 1."""
    spark = pairs.sparkSession
    diagonal = spark.createDataFrame([(c, c, 1.0) for c in columns], "col_a string, col_b string, r double")
    mirrored = pairs.select(
        F.inline(
            F.array(
                F.struct(col("col_a").alias("col_a"), col("col_b").alias("col_b"), col("r").alias("r")),
                F.struct(col("col_b").alias("col_a"), col("col_a").alias("col_b"), col("r").alias("r")),
            )
        )
    )
    return mirrored.unionByName(diagonal)


def pivot_matrix(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    return matrix.groupBy("col_a").pivot("col_b", list(columns)).agg(F.first("r"))


def threshold_correlation(pairs: DataFrame, limit: float) -> DataFrame:
    """Coefficients smaller than ``limit`` in size become zero."""
    return pairs.withColumn("r", F.when(F.abs("r") < limit, F.lit(0.0)).otherwise(col("r")))


def top_pairs(pairs: DataFrame, n: int = 30, signed: bool = False) -> DataFrame:
    """The ``n`` strongest pairs by size of r, or by r itself when ``signed``."""
    if signed:
        return pairs.orderBy(F.desc_nulls_last("r"), "col_a", "col_b").limit(n)
    sized = pairs.select("col_a", "col_b", round_even(col("r"), 4).alias("r"), round_even(F.abs("r"), 4).alias("abs_r"))
    return sized.orderBy(F.desc_nulls_last("abs_r"), "col_a", "col_b").limit(n)


def collinear_pairs(pairs: DataFrame, limit: float = L.COLLINEAR_R) -> DataFrame:
    return pairs.filter(F.abs("r") > limit)
