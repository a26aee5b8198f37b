"""Loci, odds ratios and the comparison of loci."""

from __future__ import annotations

from pyspark.sql import functions as F

from assocframe.catalogue.registry import CHR_RANK, query, rnd, with_v
from assocframe.fixtures import DISORDERS, variants
from assocframe.functions.scalars import interpret_or, odds_ratio, round_even
from assocframe.operators.loci import cluster_loci, loci_by_size, loci_summary, presence_matrix
from assocframe.operators.overlap import (
    overlap_counts,
    overlap_loci,
    overlapping_pairs,
    pair_counts,
    pair_loci,
)

_LOG = "lower(effect_kind) IN ('log_or','logor','log_odds','log_oddsratio','beta','log')"
_OR = f"CASE WHEN coalesce({_LOG}, FALSE) THEN exp(effect_size) ELSE effect_size END"


def interpretation_sql(o: str) -> str:
    def whole(x: str) -> str:
        return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"

    return (
        f"CASE WHEN {o} IS NULL THEN '—' "
        f"WHEN {o} > 1 THEN '↑ riesgo ~' || {whole(f'({o} - 1) * 100')} || '%' "
        f"WHEN {o} < 1 THEN '↓ riesgo ~' || {whole(f'(1 - {o}) * 100')} || '% (protector)' "
        f"ELSE 'Sin efecto aparente' END"
    )


def loci_ctes(window_bp: int = 250_000) -> list[str]:
    order = "PARTITION BY disorder, chr ORDER BY pos, pval, variant_id"
    return [
        "sig AS (SELECT * FROM V WHERE pval < 5e-8 AND chr IS NOT NULL AND pos IS NOT NULL)",
        f"gaps AS (SELECT *, CASE WHEN pos - lag(pos) OVER ({order}) > {window_bp} THEN 1 ELSE 0 END AS opens FROM sig)",
        f"grouped AS (SELECT *, sum(opens) OVER ({order} ROWS UNBOUNDED PRECEDING) AS gid FROM gaps)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY disorder, chr, gid ORDER BY pval, pos, variant_id) AS rn FROM grouped)",
        f"""folded AS (SELECT disorder, chr, gid, min(pos) AS start, max(pos) AS stop, count(*) AS n_snps,
              max(CASE WHEN rn = 1 THEN variant_id END) AS lead_snp, max(CASE WHEN rn = 1 THEN pos END) AS lead_pos,
              max(CASE WHEN rn = 1 THEN pval END) AS lead_pval, max(CASE WHEN rn = 1 THEN effect_size END) AS lead_effect,
              max(CASE WHEN rn = 1 THEN {_OR} END) AS lead_or_exact
            FROM ranked GROUP BY disorder, chr, gid)""",
        f"""loci AS (SELECT disorder,
              'L' || CAST(row_number() OVER (PARTITION BY disorder ORDER BY chr, start) AS VARCHAR) AS locus_id,
              chr, start, stop AS "end", {rnd('(stop - start) / 1000', 1)} AS width_kb, n_snps, lead_snp, lead_pos,
              lead_pval, {rnd('CASE WHEN lead_pval > 0 THEN -log10(lead_pval) ELSE 1e308 * 10 END', 2)} AS lead_logp,
              lead_effect, {rnd('lead_or_exact', 3)} AS lead_or, {interpretation_sql('lead_or_exact')} AS interpretation
            FROM folded)""",
    ]


def _label(side: str) -> str:
    return f"printf('%.2f–%.2f Mb', {side}.start / 1e6, {side}.\"end\" / 1e6)"


def pairs_sql(margin_bp: int) -> str:
    return f"""SELECT a.disorder AS disorder_a, b.disorder AS disorder_b, a.locus_id AS locus_a, b.locus_id AS locus_b,
                 a.chr AS chr, {_label('a')} AS region_a, {_label('b')} AS region_b,
                 (a.start - {margin_bp} <= b."end" AND b.start - {margin_bp} <= a."end") AS "overlaps"
               FROM loci a JOIN loci b ON a.chr = b.chr AND a.disorder < b.disorder"""


@query("loci_detect", with_v("SELECT * FROM loci", *loci_ctes()))
def loci_detect(spark, sf):
    return cluster_loci(variants(spark, sf)).orderBy("disorder", "chr", "start")


@query("loci_by_size", with_v("SELECT disorder, locus_id, chr, n_snps, lead_snp FROM loci ORDER BY n_snps DESC", *loci_ctes()))
def loci_by_size_(spark, sf):
    return loci_by_size(cluster_loci(variants(spark, sf))).select("disorder", "locus_id", "chr", "n_snps", "lead_snp")


@query("loci_window_100kb", with_v("SELECT * FROM loci", *loci_ctes(100_000)))
def loci_window_100kb(spark, sf):
    return cluster_loci(variants(spark, sf), window_kb=100)


@query(
    "loci_summary",
    with_v(
        f"""SELECT d.disorder AS disorder, coalesce(n_loci, 0) AS n_loci, coalesce(n_snps, 0) AS n_snps,
              snps_per_locus, coalesce(largest_locus, 0) AS largest_locus
            FROM (SELECT DISTINCT disorder FROM V) d LEFT JOIN
              (SELECT disorder, count(*) AS n_loci, CAST(sum(n_snps) AS BIGINT) AS n_snps,
                 {rnd('avg(n_snps)', 1)} AS snps_per_locus, max(n_snps) AS largest_locus
               FROM loci GROUP BY disorder) l ON d.disorder = l.disorder""",
        *loci_ctes(),
    ),
)
def loci_summary_(spark, sf):
    v = variants(spark, sf)
    return loci_summary(cluster_loci(v), v.select("disorder").distinct())


@query(
    "loci_presence_matrix",
    with_v(
        "SELECT chr, "
        + ", ".join(f"CASE WHEN max(CASE WHEN disorder = '{d}' THEN 1 ELSE 0 END) = 1 THEN '✓' ELSE '' END AS {d}" for d in DISORDERS)
        + f" FROM loci GROUP BY chr ORDER BY {CHR_RANK}, chr",
        *loci_ctes(),
    ),
)
def loci_presence_matrix(spark, sf):
    return presence_matrix(cluster_loci(variants(spark, sf)), DISORDERS)


@query("loci_pairs", with_v(pairs_sql(0), *loci_ctes()))
def loci_pairs(spark, sf):
    return pair_loci(cluster_loci(variants(spark, sf)))


@query("loci_pairs_margin", with_v(pairs_sql(250_000), *loci_ctes()))
def loci_pairs_margin(spark, sf):
    return pair_loci(cluster_loci(variants(spark, sf)), margin_kb=250)


@query(
    "loci_pairs_overlapping",
    with_v('SELECT * FROM pairs WHERE "overlaps"', *loci_ctes(), f"pairs AS ({pairs_sql(0)})"),
)
def loci_pairs_overlapping(spark, sf):
    return overlapping_pairs(cluster_loci(variants(spark, sf)))


@query(
    "loci_overlap_join",
    with_v('SELECT * EXCLUDE ("overlaps") FROM pairs WHERE "overlaps"', *loci_ctes(), f"pairs AS ({pairs_sql(0)})"),
)
def loci_overlap_join(spark, sf):
    return overlap_loci(cluster_loci(variants(spark, sf)))


@query(
    "loci_overlap_join_margin",
    with_v('SELECT * EXCLUDE ("overlaps") FROM pairs WHERE "overlaps"', *loci_ctes(), f"pairs AS ({pairs_sql(250_000)})"),
)
def loci_overlap_join_margin(spark, sf):
    return overlap_loci(cluster_loci(variants(spark, sf)), margin_kb=250)


@query(
    "loci_overlap_counts",
    with_v(
        'SELECT disorder_a, disorder_b, count(*) AS n_overlaps FROM pairs WHERE "overlaps" GROUP BY ALL',
        *loci_ctes(),
        f"pairs AS ({pairs_sql(0)})",
    ),
)
def loci_overlap_counts(spark, sf):
    return overlap_counts(overlap_loci(cluster_loci(variants(spark, sf))))


@query(
    "loci_pair_counts",
    with_v(
        """SELECT disorder_a, disorder_b, count(*) AS n_pairs,
             count(*) FILTER (WHERE "overlaps") AS n_overlaps FROM pairs GROUP BY ALL""",
        *loci_ctes(),
        f"pairs AS ({pairs_sql(0)})",
    ),
)
def loci_pair_counts(spark, sf):
    return pair_counts(cluster_loci(variants(spark, sf)))


@query(
    "odds_ratio",
    with_v(f"SELECT variant_id, pos, disorder, effect_size, effect_kind, {rnd(_OR, 9)} AS odds_ratio FROM V"),
)
def odds_ratio_(spark, sf):
    value = odds_ratio(F.col("effect_size"), F.col("effect_kind"))
    return variants(spark, sf).select(
        "variant_id", "pos", "disorder", "effect_size", "effect_kind", round_even(value, 9).alias("odds_ratio")
    )


@query(
    "or_interpretation",
    with_v(
        f"""SELECT interpretation, count(*) AS n FROM (SELECT {interpretation_sql('o')} AS interpretation
            FROM (SELECT {_OR} AS o FROM V) x) y GROUP BY interpretation"""
    ),
)
def or_interpretation(spark, sf):
    value = odds_ratio(F.col("effect_size"), F.col("effect_kind"))
    return (
        variants(spark, sf)
        .select(interpret_or(value).alias("interpretation"))
        .groupBy("interpretation")
        .agg(F.count(F.lit(1)).alias("n"))
    )
