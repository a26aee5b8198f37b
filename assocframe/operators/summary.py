"""Counts by significance tier, chromosome and disorder; top lists; reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.functions.scalars import chr_order, neg_log10, percent, round_even
from assocframe.roles import Roles, col, roles_of


def _below(p: Column, level: float | None) -> Column:
    return F.count(F.lit(1)) if level is None else F.count_if(p < F.lit(level))


def tier_counts(df: DataFrame, by: Sequence[str] = (), roles: Roles | None = None) -> DataFrame:
    """``tier, n, pct`` in one pass over the p-value column."""
    wide = tier_table(df, by, roles)
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("tier"), col(label).alias("n"), percent(col(label), col(L.TIERS[0][0]), 3).alias("pct"))
            for label, _ in L.TIERS
        ]
    )
    return wide.select(*[col(b) for b in by], F.inline(rows))


def tier_table(df: DataFrame, by: Sequence[str] = (), roles: Roles | None = None) -> DataFrame:
    """One column per tier."""
    r = roles_of(df, roles)
    r.need("pval")
    return df.groupBy(*[col(b) for b in by]).agg(
        *[_below(col(r.pval), level).alias(label) for label, level in L.TIERS]
    )


def tier_melt(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Long form of the tier table without the tier of all rows."""
    tiers = [col(label) for label, level in L.TIERS if level is not None]
    return table.unpivot([col(b) for b in by], tiers, "tier", "n")


def _first_max(key: Column, n: Column) -> Column:
    """Key of the largest count, the smallest key on ties; NULL keys and zero counts are out."""
    return F.min_by(key, F.when(key.isNotNull() & (n > 0), F.struct(-n, key)))


def _chr_stage(df: DataFrame, by: Sequence[str], r: Roles, extra: Sequence[Column] = ()) -> DataFrame:
    p = col(r.pval)
    return df.groupBy(*[col(b) for b in by], col(r.chr).cast("string").alias("_chr")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(p < F.lit(level)).alias(f"_n{i}") for i, (_, level) in enumerate(L.TIERS) if level is not None],
        *extra,
    )


def derived_metrics(df: DataFrame, by: Sequence[str] = (), roles: Roles | None = None) -> DataFrame:
    """Nominal and genome-wide counts and shares, and the chromosomes that lead.

    Shares are of all rows, rows without a p-value included.
    """
    r = roles_of(df, roles)
    r.need("pval", "chr")
    grouped = _chr_stage(df, by, r).groupBy(*[col(b) for b in by])
    return grouped.agg(*_metric_columns())


def _metric_columns() -> list[Column]:
    rows, nominal, sig = F.sum("_n"), F.sum("_n1"), F.sum("_n3")
    return [
        rows.alias("n_rows"),
        nominal.alias("n_nominal"),
        sig.alias("n_gwas"),
        percent(nominal, rows, 2).alias("pct_nominal"),
        percent(sig, rows, 4).alias("pct_gwas"),
        F.coalesce(_first_max(col("_chr"), col("_n")), F.lit(L.NO_CHR)).alias("chr_max_total"),
        F.when(sig == 0, L.NO_SIGNIFICANT_CHR)
        .otherwise(F.coalesce(_first_max(col("_chr"), col("_n3")), F.lit(L.NO_CHR)))
        .alias("chr_max_gwas"),
    ]


def dataset_summary(
    df: DataFrame,
    by: str = "disorder",
    totals: DataFrame | None = None,
    roles: Roles | None = None,
) -> DataFrame:
    """One row per data set: size, columns, chromosomes, tiers, shares, empty columns.

    ``totals`` may add facts per data set (file size, rows in the file); it has
    one row per data set and is joined on ``by``.
    """
    r = roles_of(df, roles)
    r.need("pval", "chr")
    columns = [c for c in df.columns if c != by]
    filled = [F.count(col(c)).alias(f"_filled_{i}") for i, c in enumerate(columns)]
    empty = sum(
        (F.when(F.sum(f"_filled_{i}") == 0, 1).otherwise(0) for i in range(len(columns))), F.lit(0)
    )
    out = (
        _chr_stage(df, [by], r, filled)
        .groupBy(col(by))
        .agg(
            *_metric_columns(),
            F.count(col("_chr")).alias("n_chromosomes"),
            F.sum("_n2").alias("n_suggestive"),
            empty.cast("int").alias("n_empty_columns"),
        )
        .withColumn("n_columns", F.lit(len(df.columns)))
    )
    return out if totals is None else out.join(totals, by, "left")


def chr_counts_share(
    df: DataFrame, selection: DataFrame | None = None, roles: Roles | None = None
) -> DataFrame:
    """Rows per chromosome of ``selection`` and their share of all rows of ``df``."""
    r = roles_of(df, roles)
    r.need("chr")
    total = df.agg(F.count(F.lit(1)))
    chosen = df if selection is None else selection
    return (
        chosen.filter(col(r.chr).isNotNull())
        .groupBy(col(r.chr).cast("string").alias("chr"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pct_of_all", percent(col("n"), total.scalar(), 3))
        .orderBy(F.desc("n"), "chr")
    )


def selection_size(selection: DataFrame, filtered: DataFrame) -> DataFrame:
    """Size of a selection and its percent of the filtered rows."""
    whole = filtered.agg(F.count(F.lit(1)))
    return selection.agg(F.count(F.lit(1)).alias("n")).withColumn(
        "pct_of_filtered", percent(col("n"), whole.scalar(), 1)
    )


def chr_distribution(df: DataFrame, by: Sequence[str] = (), roles: Roles | None = None) -> DataFrame:
    """Rows, significant rows and share per chromosome; NULL chromosomes are left out."""
    r = roles_of(df, roles)
    r.need("chr", "pval")
    counts = (
        df.filter(col(r.chr).isNotNull())
        .groupBy(*[col(b) for b in by], col(r.chr).cast("string").alias("chr"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(col(r.pval) < F.lit(L.GENOME_WIDE)).alias("n_gwas"))
    )
    # One row per chromosome reaches this window.
    whole = F.sum("n").over(Window.partitionBy(*[col(b) for b in by]))
    return counts.withColumn("pct", percent(col("n"), whole, 2)).orderBy(*by, F.desc("n"), "chr")


def left_counts(left: DataFrame, right: DataFrame, on: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """Left join of two count tables, missing counts become zero."""
    return left.join(right, list(on), "left").fillna(0, list(fill))


def chr_by_disorder(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    r = roles_of(df, roles)
    r.need("chr", "disorder")
    return (
        df.filter(col(r.chr).isNotNull())
        .groupBy(col(r.disorder).alias("disorder"), col(r.chr).cast("string").alias("chr"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def chr_disorder_pivot(counts: DataFrame, disorders: Sequence[str]) -> DataFrame:
    """Chromosome rows, disorder columns, zero where nothing was counted."""
    return counts.groupBy("chr").pivot("disorder", list(disorders)).agg(F.sum("n")).fillna(0)


def chr_distinct_count(df: DataFrame, by: Sequence[str] = (), roles: Roles | None = None) -> DataFrame:
    r = roles_of(df, roles)
    r.need("chr")
    keys = [col(b) for b in by]
    distinct = df.groupBy(*keys, col(r.chr).alias("_chr")).agg(F.count(F.lit(1)))
    return distinct.groupBy(*keys).agg(F.count("_chr").alias("n_chromosomes"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).filter(col(column).isNotNull()).distinct()


def chr_natural_order(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """The chromosomes present with their place in natural order."""
    r = roles_of(df, roles)
    r.need("chr")
    present = distinct_values(df.select(col(r.chr).cast("string").alias("chr")), "chr")
    place = Window.orderBy(*chr_order(col("chr")))
    return present.withColumn("place", F.row_number().over(place))


def top_associations(df: DataFrame, n: int = 20, roles: Roles | None = None) -> DataFrame:
    """The ``n`` smallest p-values with rank and -log10(p)."""
    r = roles_of(df, roles)
    r.need("pval")
    wanted = (r.snp, r.chr, r.pos, r.pval, r.effect, r.se, r.maf)
    columns = [col(c) for c in dict.fromkeys(wanted) if c is not None]
    order = [col(c) for c in (r.pval, r.chr, r.pos, r.snp) if c is not None]
    top = df.select(*columns).filter(col(r.pval).isNotNull()).orderBy(*order).limit(n)
    # The window sees at most n rows.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order))).withColumn(
        "neg_log10_p", round_even(neg_log10(col(r.pval)), 3)
    )


def sorted_associations(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Id, chromosome, position, p and effect of every row, by ascending p."""
    r = roles_of(df, roles)
    r.need("pval")
    wanted = [c for c in (r.snp, r.chr, r.pos, r.pval, r.effect) if c is not None]
    order = [col(c) for c in (r.pval, r.chr, r.pos, r.snp) if c is not None]
    return df.select(*[col(c) for c in wanted]).orderBy(*order)


def suggested_variant(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Id of the smallest p-value, NULL unless it is an rs id; rows without id or p are out."""
    r = roles_of(df, roles)
    r.need("pval", "snp")
    known = df.filter(col(r.pval).isNotNull() & col(r.snp).isNotNull())
    return known.agg(F.min(F.struct(col(r.pval), col(r.snp))).alias("_top")).select(
        F.when(col("_top").getField(r.snp).startswith("rs"), col("_top").getField(r.snp)).alias("snp"),
        col("_top").getField(r.pval).alias("pval"),
    )


def effect_summary(df: DataFrame, level: float = L.LEAD_EFFECT_LEVEL, roles: Roles | None = None) -> DataFrame:
    """Largest and mean absolute effect and smallest MAF below a p-value level."""
    r = roles_of(df, roles)
    r.need("pval", "effect", "maf")
    effect = F.abs(col(r.effect))
    return df.filter(col(r.pval) < F.lit(level)).agg(
        F.max(effect).alias("max_abs_effect"),
        F.avg(effect).alias("mean_abs_effect"),
        F.min(col(r.maf)).alias("min_maf"),
    )


def view_stats(df: DataFrame, view: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Figures of a filtered ``view`` of ``df``: rows, significant rows, top hit."""
    r = roles_of(df, roles)
    r.need("pval", "snp", "chr")
    top = F.min(F.when(col(r.pval).isNotNull(), F.struct(col(r.pval), col(r.snp))))
    return view.agg(
        F.count(F.lit(1)).alias("n_visible"),
        F.count_if(col(r.pval) < F.lit(L.GENOME_WIDE)).alias("n_gwas"),
        top.alias("_top"),
    ).select(
        "n_visible",
        "n_gwas",
        chr_distinct_count(df, roles=r).scalar().alias("n_chromosomes"),
        col("_top").getField(r.snp).alias("top_snp"),
        col("_top").getField(r.pval).alias("top_pval"),
    )
