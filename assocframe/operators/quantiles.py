"""Quantiles, describe, outliers, histograms, box and violin numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe.functions.scalars import log1p_clipped, percent, round_even
from assocframe.operators.sampling import sample_exact
from assocframe.plans.joins import group_join
from assocframe.plans.quantile import long_values, order_statistics, quantile_array
from assocframe.roles import col, to_double

FENCE = 1.5


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """``by..., column, q, value`` with linear interpolation."""
    keys = [*by, "column"]
    table, _ = quantile_array(long_values(df, columns, by), keys, qs, bounded=not by)
    pairs = F.arrays_zip(F.array(*[F.lit(float(x)) for x in qs]).alias("q"), col("q").alias("value"))
    return table.select(*[col(k) for k in keys], F.explode(pairs).alias("_p")).select(
        *[col(k) for k in keys], F.col("_p.q").alias("q"), F.col("_p.value").alias("value")
    )


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum, four digits."""
    keys = [*by, "column"]
    values = long_values(df, columns, by)
    moments = values.groupBy(*[col(k) for k in keys]).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    quartiles, few = quantile_array(values, keys, [0.25, 0.5, 0.75], bounded=not by)
    table = group_join(quartiles, moments, keys, few)
    q = [F.get("q", F.lit(i)) for i in range(3)]
    numbers = {"mean": col("mean"), "std": col("std"), "min": col("min"), "p25": q[0], "p50": q[1], "p75": q[2], "max": col("max")}
    return table.select(
        *[col(k) for k in keys],
        col("n").alias("count"),
        *[round_even(c, 4).alias(name) for name, c in numbers.items()],
    )


def _fences(q1: Column, q3: Column) -> tuple[Column, Column]:
    return q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1)


def iqr_limits(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> tuple[DataFrame, bool]:
    """Quartiles and outlier limits: ``by..., column, n, min, max, q1, q2, q3, low, high``; whether there are few groups."""
    keys = [*by, "column"]
    table, few = quantile_array(long_values(df, columns, by), keys, [0.25, 0.5, 0.75], bounded=not by)
    q1, q2, q3 = (F.get("q", F.lit(i)) for i in range(3))
    low, high = _fences(q1, q3)
    return table.select(
        *[col(k) for k in keys], "n", "min", "max", q1.alias("q1"), q2.alias("q2"), q3.alias("q3"),
        low.alias("low"), high.alias("high"),
    ), few


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    drop_zero: bool = True,
    min_rows: int = 10,
) -> DataFrame:
    """Values strictly outside the limits, per column; columns under ``min_rows`` values are skipped."""
    keys = [*by, "column"]
    limits, few = iqr_limits(df, columns, by)
    limits = limits.filter(col("n") >= min_rows).select(*keys, "n", "min", "max", "low", "high")
    values = group_join(long_values(df, columns, by), limits, keys, few)
    counted = values.groupBy(*[col(k) for k in keys], "n", "min", "max", "low", "high").agg(
        F.count_if((col("value") < col("low")) | (col("value") > col("high"))).alias("n_outliers")
    )
    if drop_zero:
        counted = counted.filter(col("n_outliers") > 0)
    return counted.select(
        *[col(k) for k in keys], "n_outliers", percent(col("n_outliers"), col("n"), 2).alias("pct_outliers"),
        "min", "max", "low", "high",
    ).orderBy(F.desc("n_outliers"), *keys)


def outlier_rows(df: DataFrame, column: str) -> DataFrame:
    """Whole rows whose value lies outside the limits of the column."""
    limits = iqr_limits(df, [column])[0].select(F.struct("low", "high")).scalar()
    value = to_double(col(column))
    return df.filter((value < limits.getField("low")) | (value > limits.getField("high")))


def sampled_iqr_outliers(
    df: DataFrame, column: str, n: int, key: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Limits from a sample of ``n`` rows, outliers counted on the whole table.

    The sample is drawn first and NULLs are dropped after; quartiles are the
    nearest sample values.
    """
    key = list(key or df.columns)
    narrow = df.select(*[col(c) for c in dict.fromkeys([*key, column])])
    values = long_values(sample_exact(narrow, n, key, seed), [column])
    ranks = [0.25, 0.75]
    table, _ = order_statistics(values, ["column"], ranks, bounded=True)

    def nearest(q: float) -> Column:
        # One of the two positions around the quantile.
        place = F.lit(q) * (col("n") - 1)
        return F.try_element_at("at", F.floor(place + 0.5))

    low, high = _fences(*[nearest(q) for q in ranks])
    limits = table.select(F.struct(low.alias("low"), high.alias("high"))).scalar()
    value = to_double(col(column))
    outside = (value < limits.getField("low")) | (value > limits.getField("high"))
    return df.agg(F.count_if(outside).alias("n_outliers")).select(
        "n_outliers", limits.getField("low").alias("low"), limits.getField("high").alias("high")
    )


def box_stats(
    df: DataFrame, column: str, by: Sequence[str] = (), log1p: bool = False
) -> DataFrame:
    """Quartiles, whisker ends (last values within the limits) and number of outliers."""
    name = column
    if log1p:
        df = df.withColumn(column, log1p_clipped(to_double(col(column))))
    keys = [*by, "column"]
    limits, few = iqr_limits(df, [column], by)
    values = group_join(long_values(df, [column], by), limits.drop("min", "max"), keys, few)
    inside = (col("value") >= col("low")) & (col("value") <= col("high"))
    return (
        values.groupBy(*[col(k) for k in keys], "n", "q1", "q2", "q3")
        .agg(
            F.min(F.when(inside, col("value"))).alias("whisker_low"),
            F.max(F.when(inside, col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .withColumn("column", F.lit(f"log1p({name})" if log1p else name))
    )


def histogram(
    df: DataFrame,
    columns: Sequence[str],
    bins: int,
    by: Sequence[str] = (),
    density: bool = False,
) -> DataFrame:
    """Counts in ``bins`` bins of equal width between minimum and maximum.

    The largest value belongs to the last bin; empty bins have no row.
    """
    keys = [*by, "column"]
    values = long_values(df, columns, by)
    bounds = values.groupBy(*[col(k) for k in keys]).agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count(F.lit(1)).alias("_total")
    )
    share = (col("value") - col("_lo")) / F.nullif(col("_hi") - col("_lo"), F.lit(0.0))
    place = F.least(F.coalesce(F.floor(share * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    width = (col("_hi") - col("_lo")) / bins
    counted = (
        group_join(values, bounds, keys, bounded=not by)
        .groupBy(*[col(k) for k in keys], "_lo", "_hi", "_total", place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    out = [*[col(k) for k in keys], col("bin"), (col("_lo") + col("bin") * width).alias("bin_low"),
           (col("_lo") + (col("bin") + 1) * width).alias("bin_high"), col("n")]
    if density:
        out.append((col("n") / F.nullif(col("_total") * width, F.lit(0.0))).alias("density"))
    return counted.select(*out)


def violin(df: DataFrame, column: str, by: Sequence[str] = (), bins: int = 40) -> DataFrame:
    """The data behind a violin: density bins of all rows, each with the box numbers of its group."""
    keys = [*by, "column"]
    box = box_stats(df, column, by).withColumnRenamed("n", "n_values")
    return group_join(histogram(df, [column], bins, by, density=True), box, keys, bounded=not by)


def density_curve(
    df: DataFrame, column: str, by: Sequence[str] = (), points: int = 100, bins: int = 512, cut: float = 2.0
) -> DataFrame:
    """``by..., n, bandwidth, x, density``: the smooth outline of a violin, a Gaussian kernel density of all rows.

    The bandwidth follows Scott's rule, per group; ``x`` goes evenly from ``cut``
    bandwidths below the minimum to as many above the maximum.  Rows are shared
    out to the two nearest of ``bins + 1`` grid places by distance, so a group is
    never more than that many weights, and the kernels of the weights are added
    up.  Groups without spread have no curve.
    """
    keys = [col(b) for b in by]
    values = long_values(df, [column], by)
    facts = values.groupBy(*keys, "column").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("_std"), F.min("value").alias("_min"), F.max("value").alias("_max")
    )
    width = (col("_std") * F.pow(col("n"), F.lit(-0.2))).alias("bandwidth")
    curves = facts.filter(col("_std") > 0).select(*keys, "column", "n", width, "_min", "_max")
    low = col("_min") - cut * col("bandwidth")
    placed = curves.withColumns({"_low": low, "_step": (col("_max") + cut * col("bandwidth") - low) / bins}).drop("_min", "_max")
    group = [*by, "column"]
    at = (col("value") - col("_low")) / col("_step")
    cells = (
        group_join(values, placed.select(*keys, "column", "_low", "_step"), group, bounded=not by)
        .select(*keys, "column", F.floor(at).cast("int").alias("_cell"), (at - F.floor(at)).alias("_share"))
        .groupBy(*keys, "column", "_cell")
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum("_share").alias("_share"))
    )
    weights = F.array(
        F.struct(col("_cell").alias("i"), (col("_rows") - col("_share")).alias("w")), F.struct((col("_cell") + 1).alias("i"), col("_share").alias("w"))
    )
    grid = cells.select(*keys, "column", F.inline(weights)).groupBy(*keys, "column", "i").agg(F.sum("w").alias("w"))
    # At most bins + 1 weights a group.
    listed = grid.groupBy(*keys, "column").agg(F.array_sort(F.collect_list(F.struct("i", "w"))).alias("_grid"))
    both = group_join(listed, placed, group, bounded=not by)
    place = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_point")
    spots = both.select("*", place).withColumn("x", col("_low") + col("_point") * (col("_step") * bins / (points - 1)))
    kernel = F.aggregate(
        "_grid", F.lit(0.0), lambda total, g: total + g["w"] * F.exp(-0.5 * F.pow((col("x") - col("_low") - g["i"] * col("_step")) / col("bandwidth"), F.lit(2)))
    )
    density = kernel / (col("n") * col("bandwidth") * math.sqrt(2 * math.pi))
    return spots.select(*keys, "n", "bandwidth", "x", density.alias("density"))
