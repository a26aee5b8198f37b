"""Repeatable exact-size samples.

Rows are ordered by the md5 of a seed and a key, and the first ``n`` are kept, so
the result does not depend on partitioning.  One scan counts groups, which gives
a hash below which a few more rows than wanted lie; the second scan keeps those
and ranks them, in buckets of bounded size.  Groups that still lack rows, as
their keys repeat, are topped up by a third scan, left out at run time if none do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocframe.functions.scalars import neg_log10
from assocframe.operators.filters import drop_incomplete
from assocframe.plans.joins import few_groups, group_join
from assocframe.plans.materialize import materialize
from assocframe.roles import SCATTER_ALIASES, MissingRole, Roles, col, pick, roles_of, to_double

_DIGITS = 8  # hex digits that cuts are made by
_RANKED = 250_000  # rows ranked in one task


def sample_hash(key: Sequence[str], seed: int = 42) -> Column:
    """md5 of seed and key columns; key columns should identify a row."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def sample_exact(
    df: DataFrame, n: int, key: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Exactly ``n`` rows, or all of them when there are no more than ``n``."""
    return _quota_sample(df, [], F.lit(n), n, key, seed)


def _quota_sample(
    df: DataFrame, by: Sequence[str], quota: Column, most: int, key: Sequence[str] | None, seed: int
) -> DataFrame:
    """Per group the rows with the smallest hashes; ``quota`` (at most ``most``) sees ``_total``, the group size, and
    ``_all_rows``, that of the table."""
    columns = [col(c) for c in df.columns]
    hashed = df.withColumns({"_hash": sample_hash(key or df.columns, seed), "_tie": F.xxhash64(*columns), "_every": F.lit(True)})
    keys = list(by) or ["_every"]
    limits = _cuts(hashed, keys, quota)
    few = not by
    if by:
        # Written and measured: with few groups the table is cut where it is read and only rows near the cuts travel.
        limits = materialize(limits)
        few = few_groups(limits)
    prefix = F.left("_hash", F.lit(_DIGITS))
    near = group_join(hashed, limits, keys, few).filter(prefix < col("_cut"))

    # Rows ranked in one task are few: more are cut into buckets by their hash.
    buckets = max(1, -(-most // _RANKED))
    share = F.conv(prefix, 16, 10).cast("double") / col("_width")
    bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")
    own = Window.partitionBy(*[col(k) for k in keys], "_bucket")
    ranked = near.withColumn("_bucket", bucket).withColumns(
        {"_rank": F.row_number().over(own.orderBy("_hash", "_tie")), "_rows": F.count(F.lit(1)).over(own)}
    )
    sizes = _bucket_sizes(ranked, keys, [*df.columns, "_hash"])
    placed = group_join(ranked, sizes.select(*[col(k) for k in keys], "_bucket", "_before"), [*keys, "_bucket"], few and (not by or buckets == 1))
    picked = placed.filter(col("_before") + col("_rank") <= col("_quota"))

    # Hashes of rows that share a key come in clumps, so a group may still lack rows behind its cut.
    found = sizes.groupBy(*[col(k) for k in keys]).agg(F.sum("_size").alias("_found"))
    short = _lacking(limits, found, keys)
    rest = group_join(hashed, short, keys, few).filter(prefix >= col("_cut"))
    after = Window.partitionBy(*[col(k) for k in keys]).orderBy("_hash", "_tie")
    topped = rest.withColumn("_rank", F.row_number().over(after)).filter((col("_rank") <= most) & (col("_rank") <= col("_lack")))
    return picked.select(*columns).unionByName(topped.select(*columns))


def _cuts(hashed: DataFrame, keys: Sequence[str], quota: Column) -> DataFrame:
    """Per group its quota and a hash below which, by nine standard deviations, enough rows lie."""
    totals = hashed.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_total"))
    every = totals.agg(F.coalesce(F.sum("_total"), F.lit(0))).scalar()
    wanted = totals.withColumn("_all_rows", every).withColumn("_quota", quota.cast("bigint"))
    share = (col("_quota") + 9 * F.sqrt(col("_quota")) + 81) / col("_total")
    whole = 1 << 4 * _DIGITS
    width = F.ceil(F.least(share, F.lit(1.0)) * float(whole)).cast("bigint")
    # No hash reaches "g": such a group is taken whole.
    cut = F.when(width >= whole, F.lit("g")).otherwise(F.lpad(F.lower(F.hex(width)), _DIGITS, "0"))
    return wanted.select(*[col(k) for k in keys], "_total", "_quota", width.alias("_width"), cut.alias("_cut"))


def _bucket_sizes(ranked: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of each bucket and of those before it, one row per bucket.

    A figure of all columns is asked for along with the first rows, so that Spark
    finds the ranked rows' own exchange and does not scan the table again.
    """
    by = [col(k) for k in keys]
    firsts = ranked.filter(col("_rank") == 1).groupBy(*by, "_bucket").agg(
        F.max("_rows").alias("_size"), F.max(F.xxhash64("_tie", "_hash", "_quota", *[col(c) for c in columns])).alias("_seen")
    )
    along = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = firsts.filter(col("_seen").isNotNull()).withColumn("_before", F.coalesce(F.sum("_size").over(along), F.lit(0)))
    return sizes.select(*by, "_bucket", "_size", "_before")


def _lacking(limits: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with fewer rows below their cut than their quota, and how many they lack."""
    right = {k: f"_right_{i}" for i, k in enumerate(keys)}
    match = F.lit(True)
    for k, name in right.items():
        match = match & col(k).eqNullSafe(col(name))
    both = limits.join(found.select(*[col(k).alias(name) for k, name in right.items()], "_found"), match, "left")
    lack = F.least(col("_quota"), col("_total")) - F.coalesce("_found", F.lit(0))
    return both.select(*[col(k) for k in keys], "_cut", lack.alias("_lack")).filter("_lack > 0")


def sample_per_group(
    df: DataFrame, n: int, by: Sequence[str], key: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """At most ``n`` rows of every group."""
    return _quota_sample(df, by, F.lit(n), n, key, seed)


def sample_proportional(
    df: DataFrame,
    cap: int,
    strata: Sequence[str],
    key: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """About ``cap`` rows, each stratum giving ``max(1, int(rows * cap / total))``; all rows if there are no more."""
    share = F.least(F.lit(1.0), F.lit(float(cap)) / F.greatest(col("_all_rows"), F.lit(1)))
    return _quota_sample(df, strata, F.greatest(F.lit(1), F.floor(col("_total") * share)), cap, key, seed)


def pvalue_sample_per_disorder(
    df: DataFrame,
    n: int,
    key: Sequence[str] | None = None,
    seed: int = 42,
    roles: Roles | None = None,
) -> DataFrame:
    """``disorder, neg_log10_p`` of at most ``n`` clean p-values per disorder."""
    r = roles_of(df, roles)
    r.need("pval", "disorder")
    clean = df.filter(col(r.pval) > 0)
    return sample_per_group(clean, n, [r.disorder], key, seed).select(
        col(r.disorder).alias("disorder"), neg_log10(col(r.pval)).alias("neg_log10_p")
    )


def scatter_points(
    df: DataFrame,
    columns: Sequence[str],
    cap: int | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Rows complete in the plotted ``columns``; with ``cap`` a sample of at most so many."""
    complete = drop_incomplete(df, columns)
    if cap is not None:
        narrow = complete.select(*[col(c) for c in dict.fromkeys([*columns, *(key or df.columns)])])
        complete = sample_exact(narrow, cap, key, seed)
    return complete.select(*[col(c) for c in columns])


def pval_maf_points(
    df: DataFrame,
    cap: int | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
    impute: bool = False,
) -> DataFrame:
    """``maf, pval`` points; a missing p counts as 1, a missing MAF is left out.

    ``impute=True`` fills missing MAF with flagged random numbers instead;
    ``cap`` asks for a sample of at most so many points.
    """
    p, maf = (pick(df.columns, SCATTER_ALIASES[role]) for role in ("pval", "maf"))
    if p is None or maf is None:
        raise MissingRole("no columns play the roles pval and maf of a scatter")
    key = list(key or df.columns)
    points = df.withColumns({"_maf": to_double(col(maf)), "_p": F.coalesce(to_double(col(p)), F.lit(1.0))})
    if impute:
        points = impute_uniform(points, "_maf", key, seed=seed)
    picked = drop_incomplete(points, ["_maf"])
    if cap is not None:
        shown = ["_maf", "_p", *(["is_imputed"] if impute else [])]
        picked = sample_exact(picked.select(*[col(c) for c in dict.fromkeys([*key, *shown])]), cap, key, seed)
    flag = [col("is_imputed")] if impute else []
    return picked.select(col("_maf").alias("maf"), col("_p").alias("pval"), *flag)


def impute_uniform(
    df: DataFrame,
    column: str,
    key: Sequence[str],
    low: float = 0.01,
    high: float = 0.50,
    seed: int = 42,
) -> DataFrame:
    """Fill NULLs with uniform numbers drawn from a hash of the key, and flag them.

    Opt-in only: filled values are invented, so ``is_imputed`` marks them.
    """
    # 48 bits of the hash as a number in [0, 1).
    draw = F.conv(F.left(sample_hash(key, seed), F.lit(12)), 16, 10).cast("bigint") / float(1 << 48)
    return df.withColumn("is_imputed", col(column).isNull()).withColumn(
        column, F.coalesce(col(column), F.lit(low) + F.lit(high - low) * draw)
    )


def sample_key(df: DataFrame, roles: Roles | None = None) -> list[str]:
    """Columns that tell variants apart; all columns when there is neither id nor position.

    A short key lets the first pass of a sample read only these columns.  The
    numbers are part of it so that rows without an id do not share one hash.
    """
    r = roles_of(df, roles)
    if r.snp is None and r.pos is None:
        return list(df.columns)
    source = "source_file" if "source_file" in df.columns else None
    found = (r.disorder, r.snp, r.chr, r.pos, r.pval, r.effect, source)
    return [c for c in found if c is not None]
