"""Grouping significant variants into loci."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.functions.scalars import chr_order, interpret_or, neg_log10_inf, odds_ratio, round_even
from assocframe.roles import Roles, col, roles_of, to_double, to_long

LOCI_SCHEMA = (
    "locus_id string, chr string, start bigint, end bigint, width_kb double, n_snps bigint, "
    "lead_snp string, lead_pos bigint, lead_pval double, lead_logp double, lead_effect double, "
    "lead_or double, interpretation string"
)


def _by_columns(r: Roles, by: Sequence[str] | None) -> list[str]:
    if by is not None:
        return list(by)
    return [r.disorder] if r.disorder is not None else []


def cluster_loci(
    df: DataFrame,
    window_kb: float = L.LOCUS_WINDOW_KB,
    level: float = L.GENOME_WIDE,
    by: Sequence[str] | None = None,
    roles: Roles | None = None,
) -> DataFrame:
    """Loci of the variants with ``p < level``; a gap above the window starts a new locus.

    Positions are cut into cells one window wide.  Two variants of a cell are
    never more than a window apart, so a cell always lies inside one locus and
    is reduced to its ends, count and lead variant before anything else; how
    many variants share a chromosome no longer matters after that.  Only cells
    are put in order to find the gaps, at most chromosome length / window of
    them per chromosome.
    """
    r = roles_of(df, roles)
    keys = _by_columns(r, by)
    names = ["disorder" if k == r.disorder else k for k in keys]
    if not r.has("chr", "pos", "pval"):
        key_schema = "".join(f"{n} string, " for n in names)
        return df.sparkSession.createDataFrame([], key_schema + LOCI_SCHEMA)
    window = int(window_kb * 1000)
    group = [*names, "chr"]

    def optional(name: str | None, convert=lambda c: c, kind: str = "string") -> Column:
        return convert(col(name)) if name is not None else F.lit(None).cast(kind)

    numeric_p = dict(df.dtypes)[r.pval] in ("double", "float")
    p = col(r.pval) if numeric_p else to_double(col(r.pval))
    numeric_pos = dict(df.dtypes)[r.pos] in ("bigint", "int", "smallint", "tinyint")
    variants = df.filter((p < F.lit(level)) & col(r.chr).isNotNull()).select(
        *[col(k).alias(n) for k, n in zip(keys, names)],
        col(r.chr).cast("string").alias("chr"),
        (col(r.pos).cast("bigint") if numeric_pos else to_long(col(r.pos))).alias("pos"),
        p.cast("double").alias("pval"),
        optional(r.snp, lambda c: c.cast("string")).alias("snp"),
        optional(r.or_effect, to_double, "double").alias("effect"),
        optional(r.effect_kind).alias("kind"),
        optional(r.direct_or, to_double, "double").alias("direct"),
        optional(r.settled_or, to_double, "double").alias("settled"),
    ).filter(col("pos").isNotNull())

    lead = F.min(F.struct("pval", "pos", "snp", "effect", "kind", "direct", "settled"))
    cell = col("pos") - F.pmod(col("pos"), F.lit(window + 1))
    cells = variants.groupBy(*group, cell.alias("cell")).agg(
        F.min("pos").alias("start"), F.max("pos").alias("end"), F.count(F.lit(1)).alias("n_snps"), lead.alias("lead")
    )
    along = Window.partitionBy(*group).orderBy("cell")
    opens = (col("start") - F.lag("end").over(along) > F.lit(window)).cast("int")
    loci = (
        cells.withColumn("opens", F.coalesce(opens, F.lit(0)))
        .withColumn("locus", F.sum("opens").over(along))
        .groupBy(*group, "locus")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("n_snps").alias("n_snps"),
            F.min("lead").alias("lead"),
        )
    )
    place = Window.partitionBy(*names).orderBy("chr", "start")
    lead_or = odds_ratio(
        F.col("lead.effect") if r.or_effect is not None else None,
        F.col("lead.kind") if r.effect_kind is not None else None,
        F.col("lead.direct") if r.direct_or is not None else None,
    )
    if r.settled_or is not None:  # files of different headers: each one's own roles decided
        lead_or = F.col("lead.settled")
    return loci.withColumn("or_exact", lead_or).select(
        *[col(n) for n in names],
        F.concat(F.lit("L"), F.row_number().over(place)).alias("locus_id"),
        "chr",
        "start",
        "end",
        round_even((col("end") - col("start")) / 1000, 1).alias("width_kb"),
        "n_snps",
        F.col("lead.snp").alias("lead_snp"),
        F.col("lead.pos").alias("lead_pos"),
        F.col("lead.pval").alias("lead_pval"),
        round_even(neg_log10_inf(F.col("lead.pval")), 2).alias("lead_logp"),
        F.col("lead.effect").alias("lead_effect"),
        round_even(col("or_exact"), 3).alias("lead_or"),
        interpret_or(col("or_exact")).alias("interpretation"),
    )


def loci_summary(loci: DataFrame, disorders: DataFrame | None = None) -> DataFrame:
    """Loci, grouped variants, variants per locus and the biggest locus, per disorder.

    ``disorders`` is a one-column table; disorders without a locus get zeros.
    """
    found = loci.groupBy("disorder").agg(
        F.count(F.lit(1)).alias("n_loci"),
        F.sum("n_snps").alias("n_snps"),
        round_even(F.avg("n_snps"), 1).alias("snps_per_locus"),
        F.max("n_snps").alias("largest_locus"),
    )
    if disorders is None:
        return found
    counts = ["n_loci", "n_snps", "largest_locus"]
    return disorders.join(found, "disorder", "left").fillna(0, counts)


def loci_by_size(loci: DataFrame) -> DataFrame:
    """Loci by number of variants, the largest first."""
    return loci.orderBy(F.desc("n_snps"), "lead_pval", "chr", "start")


def presence_matrix(loci: DataFrame, disorders: Sequence[str]) -> DataFrame:
    """Chromosome rows in natural order, a mark per disorder with a locus there."""
    marks = loci.select("chr", "disorder").distinct().groupBy("chr").pivot("disorder", list(disorders)).agg(
        F.first(F.lit(L.PRESENT))
    )
    return marks.fillna(L.ABSENT, list(disorders)).orderBy(*chr_order(col("chr")))
