"""Genomic inflation factor and QQ points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.functions.scalars import chi2_from_p, inflation_band
from assocframe.operators.sampling import sample_exact, sample_key
from assocframe.plans.ordering import numbered_values
from assocframe.plans.quantile import long_values, middle_values
from assocframe.roles import Roles, col, roles_of


def lambda_gc(
    df: DataFrame,
    method: str = "chi2",
    by: Sequence[str] = (),
    sample_n: int | None = None,
    roles: Roles | None = None,
) -> DataFrame:
    """Inflation factor of the clean p-values and its band.

    ``chi2`` is the standard factor, the median chi-square statistic over its
    expected median.  ``p_ratio`` divides the median p-value itself.  All rows
    are used unless ``sample_n`` asks for a sample.
    """
    r = roles_of(df, roles)
    r.need("pval")
    clean = df.filter(col(r.pval) > 0)
    if sample_n is not None:
        clean = sample_exact(clean, sample_n, sample_key(df, r))
    middle = middle_values(long_values(clean, [r.pval], by), [*by, "column"], bounded=not by)
    if method == "p_ratio":
        median: Column = (col("lower") + col("upper")) / 2.0
    elif method == "chi2":
        median = (chi2_from_p("lower") + chi2_from_p("upper")) / 2.0
    else:
        raise ValueError("method must be 'chi2' or 'p_ratio'")
    scored = middle.select(*[col(b) for b in by], "n", (median / F.lit(L.CHI2_MEDIAN_1DF)).alias("lambda_gc"))
    return scored.withColumn("band", inflation_band(col("lambda_gc")))


def qq_points(
    df: DataFrame,
    n: int | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
    roles: Roles | None = None,
) -> DataFrame:
    """``i, expected, observed``: p-values in order against their even spread.

    All rows are ranked by a distributed sort of their distinct p-values; ``n``
    asks for an exact-size sample first.
    """
    r = roles_of(df, roles)
    r.need("pval")
    clean = df.filter(col(r.pval) > 0)
    if n is not None:
        key = list(key or sample_key(df, r))
        clean = sample_exact(clean.select(*[col(c) for c in dict.fromkeys([*key, r.pval])]), n, key, seed)
    points = clean.select(col(r.pval).alias("p"))
    ranked = numbered_values(points, "p", "i")
    total = points.agg(F.count(F.lit(1))).scalar()
    return ranked.select(
        "i", (-F.log10(col("i") / total)).alias("expected"), (-F.log10("p")).alias("observed")
    )
