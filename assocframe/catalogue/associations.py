"""Significance, chromosomes, disorders, top lists and plot feeds."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.catalogue.registry import CHR_RANK, pct, query, rnd, with_v
from assocframe.fixtures import DISORDERS, table, variants
from assocframe.functions.scalars import chi2_from_p_sql, chr_rank, inflation_band, neg_log10, percent_text, round_even
from assocframe.operators.filters import (
    association_columns,
    association_filter,
    chr_filter,
    clean_pvalues,
    level_filter,
    logp_filter,
    rsid_list,
)
from assocframe.operators.inflation import lambda_gc, qq_points
from assocframe.operators.manhattan import manhattan_points
from assocframe.operators.summary import (
    chr_by_disorder,
    chr_counts_share,
    chr_disorder_pivot,
    chr_distinct_count,
    chr_distribution,
    chr_natural_order,
    dataset_summary,
    derived_metrics,
    effect_summary,
    left_counts,
    selection_size,
    sorted_associations,
    suggested_variant,
    tier_counts,
    tier_melt,
    tier_table,
    top_associations,
    view_stats,
)
from assocframe.plans.materialize import shared_dir
from assocframe.roles import canonicalize
from assocframe.sources.files import file_sizes
from assocframe.sources.load import load, significant

_MIXED_OR = "CASE WHEN lower(effect_kind) IN ('log_or','logor','log_odds','log_oddsratio','beta','log') THEN exp(effect_size) ELSE effect_size END"
_TIERS = (("Todas", "count(*)"), ("p < 0.05", "count(*) FILTER (WHERE pval < 5e-2)"),
          ("p < 1e-5", "count(*) FILTER (WHERE pval < 1e-5)"), ("p < 5e-8", "count(*) FILTER (WHERE pval < 5e-8)"))


def _tier_rows(keys: str) -> str:
    group = f"GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{label}' AS tier, {expr} AS n, {pct(expr, 'count(*)', 3)} AS pct FROM V {group}"
        for label, expr in _TIERS
    )


@query("tier_counts", with_v(_tier_rows("")))
def tier_counts_(spark, sf):
    return tier_counts(variants(spark, sf))


@query("tier_counts_by_disorder", with_v(_tier_rows("disorder")))
def tier_counts_by_disorder(spark, sf):
    return tier_counts(variants(spark, sf), ["disorder"])


@query("tier_melt", with_v(f"SELECT disorder, tier, n FROM ({_tier_rows('disorder')}) x WHERE tier <> 'Todas'"))
def tier_melt_(spark, sf):
    return tier_melt(tier_table(variants(spark, sf), ["disorder"]), ["disorder"])


def _metrics(where: str) -> str:
    lead = "(SELECT chr FROM V x WHERE chr IS NOT NULL {w} {more} GROUP BY chr ORDER BY count(*) DESC, chr LIMIT 1)"
    total = lead.format(w=where, more="")
    sig = lead.format(w=where, more="AND pval < 5e-8")
    n, nom, gw = (e for _, e in (_TIERS[0], _TIERS[1], _TIERS[3]))
    return f"""{n} AS n_rows, {nom} AS n_nominal, {gw} AS n_gwas, {pct(nom, n, 2)} AS pct_nominal,
               {pct(gw, n, 4)} AS pct_gwas, coalesce({total}, '—') AS chr_max_total,
               CASE WHEN {gw} = 0 THEN 'Ninguno' ELSE coalesce({sig}, '—') END AS chr_max_gwas"""


def _metrics_by_disorder(more: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS disorder, {_metrics(f'''AND disorder = '{d}' ''')}{more} FROM V WHERE disorder = '{d}'"
        for d in DISORDERS
    )


@query("derived_metrics", with_v(f"SELECT {_metrics('')} FROM V"))
def derived_metrics_(spark, sf):
    return derived_metrics(variants(spark, sf))


@query("derived_metrics_by_disorder", with_v(_metrics_by_disorder()))
def derived_metrics_by_disorder(spark, sf):
    return derived_metrics(variants(spark, sf), ["disorder"])


@query(
    "derived_metrics_text",
    with_v(
        f"""SELECT disorder, printf('%.2f%%', pct_nominal) AS nominal, printf('%.4f%%', pct_gwas) AS gwas
            FROM ({_metrics_by_disorder()}) m"""
    ),
)
def derived_metrics_text(spark, sf):
    return derived_metrics(variants(spark, sf), ["disorder"]).select(
        "disorder", percent_text(F.col("pct_nominal"), 2).alias("nominal"), percent_text(F.col("pct_gwas"), 4).alias("gwas")
    )


_EMPTY = " + ".join(
    f"CASE WHEN count({c}) = 0 THEN 1 ELSE 0 END"
    for c in ("variant_id", "chr", "pos", "pval", "effect_size", "effect_kind", "se", "maf", "info")
)


@query(
    "dataset_summary",
    with_v(
        _metrics_by_disorder(
            f""", count(DISTINCT chr) AS n_chromosomes, count(*) FILTER (WHERE pval < 1e-5) AS n_suggestive,
                CAST({_EMPTY} AS INTEGER) AS n_empty_columns, 10 AS n_columns"""
        )
    ),
)
def dataset_summary_(spark, sf):
    return dataset_summary(variants(spark, sf))


@query(
    "dataset_summary_files",
    with_v("SELECT disorder, count(*) AS n_rows, count(*) FILTER (WHERE pval < 5e-8) AS n_gwas, count(*) AS file_rows, TRUE AS has_size FROM V GROUP BY disorder"),
)
def dataset_summary_files(spark, sf):
    """The summary with rows and megabytes of the files behind each data set."""
    folder = f"{shared_dir(spark)}/summary-{uuid.uuid4().hex}"
    for d in DISORDERS:
        variants(spark, sf).filter(F.col("disorder") == d).write.parquet(f"{folder}/{d}")
    name = {d: load(spark, f"{folder}/{d}").df for d in DISORDERS}
    facts = [file_sizes(spark, f"{folder}/{d}").agg(F.sum("mb").alias("mb"), F.sum("n_rows").alias("file_rows")).withColumn("disorder", F.lit(d)) for d in DISORDERS]
    united, totals = (reduce(lambda a, b: a.unionByName(b), parts) for parts in (list(name.values()), facts))
    out = dataset_summary(united, totals=totals)
    return out.select("disorder", "n_rows", "n_gwas", "file_rows", (F.col("mb") > 0).alias("has_size"))


_SELECTION = "pval < 5e-2 AND chr IN ('1', '2', 'X')"


def _selection(v):
    return chr_filter(level_filter(v, 0.05), ["1", "2", "X"])


@query(
    "chr_counts_share",
    with_v(
        f"""SELECT chr, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM V)', 3)} AS pct_of_all
            FROM V WHERE {_SELECTION} GROUP BY chr"""
    ),
)
def chr_counts_share_(spark, sf):
    v = variants(spark, sf)
    return chr_counts_share(v, _selection(v))


@query(
    "selection_size",
    with_v(
        f"""SELECT count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM V WHERE pval < 5e-2)', 1)} AS pct_of_filtered
            FROM V WHERE {_SELECTION}"""
    ),
)
def selection_size_(spark, sf):
    v = variants(spark, sf)
    return selection_size(_selection(v), level_filter(v, 0.05))


_DIST = f"""SELECT chr, count(*) AS n, count(*) FILTER (WHERE pval < 5e-8) AS n_gwas,
              {pct('count(*)', '(SELECT count(*) FROM V WHERE chr IS NOT NULL)', 2)} AS pct
            FROM V WHERE chr IS NOT NULL GROUP BY chr"""


@query("chr_distribution", with_v(_DIST))
def chr_distribution_(spark, sf):
    return chr_distribution(variants(spark, sf))


@query(
    "chr_left_counts",
    with_v(
        """SELECT t.chr AS chr, t.n AS n, coalesce(s.n_gwas, 0) AS n_gwas
           FROM (SELECT chr, count(*) AS n FROM V WHERE chr IS NOT NULL GROUP BY chr) t
           LEFT JOIN (SELECT chr, count(*) AS n_gwas FROM V WHERE pval < 5e-8 AND chr IS NOT NULL GROUP BY chr) s
           ON t.chr = s.chr"""
    ),
)
def chr_left_counts(spark, sf):
    v = variants(spark, sf).filter("chr IS NOT NULL")
    total = v.groupBy("chr").agg(F.count(F.lit(1)).alias("n"))
    hits = significant(v).groupBy("chr").agg(F.count(F.lit(1)).alias("n_gwas"))
    return left_counts(total, hits, ["chr"], ["n_gwas"])


@query("chr_by_disorder", with_v("SELECT disorder, chr, count(*) AS n FROM V WHERE chr IS NOT NULL GROUP BY disorder, chr"))
def chr_by_disorder_(spark, sf):
    return chr_by_disorder(variants(spark, sf))


@query(
    "chr_disorder_pivot",
    with_v(
        "SELECT chr, "
        + ", ".join(f"count(*) FILTER (WHERE disorder = '{d}') AS {d}" for d in DISORDERS)
        + " FROM V WHERE chr IS NOT NULL GROUP BY chr"
    ),
)
def chr_disorder_pivot_(spark, sf):
    return chr_disorder_pivot(chr_by_disorder(variants(spark, sf)), DISORDERS)


@query("chr_distinct", with_v("SELECT disorder, count(DISTINCT chr) AS n_chromosomes FROM V GROUP BY disorder"))
def chr_distinct(spark, sf):
    return chr_distinct_count(variants(spark, sf), ["disorder"])


@query(
    "chr_natural_order",
    with_v(
        f"""SELECT chr, CAST(row_number() OVER (ORDER BY {CHR_RANK}, chr) AS INTEGER) AS place
            FROM (SELECT DISTINCT chr FROM V WHERE chr IS NOT NULL) c"""
    ),
)
def chr_natural_order_(spark, sf):
    return chr_natural_order(variants(spark, sf))


@query("significant_scan", with_v("SELECT * FROM V WHERE pval < 5e-8"))
def significant_scan(spark, sf):
    return significant(variants(spark, sf))


@query(
    "load_gwas_mode",
    with_v(
        """SELECT variant_id AS snp_id, chr, pos, pval, effect_size, effect_kind, se, maf, info, disorder
           FROM V WHERE pval < 5e-8"""
    ),
)
def load_gwas_mode(spark, sf):
    """Three files with two kinds of headers, loaded as one table in the significance mode."""
    folder = f"{shared_dir(spark)}/load-{uuid.uuid4().hex}"
    v = variants(spark, sf)
    v.filter("disorder <> 'ptsd'").write.parquet(f"{folder}/first")
    other = {"pval": "P_VALUE", "chr": "CHROM", "pos": "BP", "variant_id": "SNP", "effect_size": "BETA", "disorder": "PHENOTYPE"}
    v.filter("disorder = 'ptsd'").withColumnsRenamed(other).write.parquet(f"{folder}/second")
    return load(spark, [f"{folder}/first", f"{folder}/second"], mode="gwas").df.drop("source_file")


_MIXED = {"adhd": "exp(effect_size)", "bpd": _MIXED_OR, "ptsd": "effect_size"}
_MIXED_ROWS = " UNION ALL ".join(
    f"""SELECT variant_id AS snp_id, CASE WHEN disorder <> 'ptsd' OR regexp_full_match(chr, '[0-9]+') THEN chr END AS chr, pos, pval, disorder,
          {rnd(value, 9)} AS settled_or, {rnd('effect_size', 9)} AS shown_effect FROM V WHERE disorder = '{d}' AND chr IS NOT NULL"""
    for d, value in _MIXED.items()
)


@query("load_mixed_headers", with_v(_MIXED_ROWS))
def load_mixed_headers(spark, sf):
    """A beta without a kind, an effect with a kind, and a plain odds ratio with whole-number chromosomes."""
    folder = f"{shared_dir(spark)}/mixed-{uuid.uuid4().hex}"
    v = variants(spark, sf).filter("chr IS NOT NULL")
    v.filter("disorder = 'adhd'").drop("effect_kind").withColumnRenamed("effect_size", "beta").write.parquet(f"{folder}/a")
    v.filter("disorder = 'bpd'").write.parquet(f"{folder}/b")
    plain = v.filter("disorder = 'ptsd'").drop("effect_kind").withColumnRenamed("effect_size", "or")
    plain.withColumn("chr", F.col("chr").try_cast("int")).write.parquet(f"{folder}/c")
    out = load(spark, [f"{folder}/{x}" for x in "abc"]).df
    shown = [round_even(F.col(c), 9).alias(c) for c in ("settled_or", "shown_effect")]
    return out.select("snp_id", "chr", "pos", "pval", "disorder", *shown)


@query(
    "load_fallback",
    with_v("SELECT variant_id AS snp_id, disorder, CASE WHEN disorder <> 'ptsd' THEN pval END AS pval FROM V WHERE disorder = 'ptsd' OR pval < 5e-8"),
)
def load_fallback(spark, sf):
    """The significance mode over files of which one has no p-value: that one is loaded whole."""
    folder = f"{shared_dir(spark)}/fallback-{uuid.uuid4().hex}"
    v = variants(spark, sf)
    v.filter("disorder <> 'ptsd'").write.parquet(f"{folder}/with")
    v.filter("disorder = 'ptsd'").drop("pval").write.parquet(f"{folder}/without")
    return load(spark, [f"{folder}/with", f"{folder}/without"], mode="gwas").df.select("snp_id", "disorder", "pval")


@query("level_filter", with_v("SELECT * FROM V WHERE pval < 1e-5"))
def level_filter_(spark, sf):
    return level_filter(variants(spark, sf), 1e-5)


@query("chr_filter", with_v("SELECT variant_id, chr, pos, pval FROM V WHERE chr IN ('10', 'X')"))
def chr_filter_(spark, sf):
    return chr_filter(variants(spark, sf), ["10", "X"]).select("variant_id", "chr", "pos", "pval")


@query(
    "compound_filter",
    with_v("SELECT variant_id, chr, pos, pval, effect_size FROM V WHERE disorder = 'bpd' AND pval < 5e-6 AND abs(effect_size) > 0.1"),
)
def compound_filter(spark, sf):
    return sorted_associations(association_filter(variants(spark, sf), "bpd", 5e-6, 0.1))


@query("logp_threshold", with_v("SELECT variant_id, chr, pos, pval FROM V WHERE pval < 1e-3"))
def logp_threshold(spark, sf):
    return logp_filter(variants(spark, sf), 3.0).select("variant_id", "chr", "pos", "pval")


@query("clean_pvalues", with_v(f"SELECT variant_id, pos, {rnd('-log10(pval)', 9)} AS neg_log10_p FROM V WHERE pval > 0"))
def clean_pvalues_(spark, sf):
    v = clean_pvalues(variants(spark, sf))
    return v.select("variant_id", "pos", round_even(neg_log10(F.col("pval")), 9).alias("neg_log10_p"))


@query("association_columns", with_v("SELECT variant_id, chr, pos, pval, effect_size, se, maf FROM V"))
def association_columns_(spark, sf):
    return association_columns(variants(spark, sf))


@query(
    "top20",
    with_v(
        f"""SELECT variant_id, chr, pos, pval, effect_size, se, maf,
              CAST(row_number() OVER (ORDER BY pval, chr, pos, variant_id) AS INTEGER) AS rank,
              {rnd('-log10(pval)', 3)} AS neg_log10_p
            FROM (SELECT * FROM V WHERE pval IS NOT NULL ORDER BY pval, chr NULLS FIRST, pos, variant_id LIMIT 20) x"""
    ),
)
def top20(spark, sf):
    return top_associations(variants(spark, sf), 20)


@query("suggested_variant", with_v("SELECT CASE WHEN variant_id LIKE 'rs%' THEN variant_id END AS snp, pval FROM V WHERE variant_id IS NOT NULL AND pval IS NOT NULL ORDER BY pval, variant_id LIMIT 1"))
def suggested_variant_(spark, sf):
    return suggested_variant(variants(spark, sf))


@query("rsid_list", with_v("SELECT DISTINCT variant_id AS snp FROM V WHERE lower(variant_id) LIKE 'rs%'"))
def rsid_list_(spark, sf):
    return rsid_list(variants(spark, sf))


@query(
    "effect_summary",
    with_v(
        f"""SELECT max(abs(effect_size)) AS max_abs_effect, {rnd('avg(abs(effect_size))', 9)} AS mean_abs_effect,
              min(maf) AS min_maf FROM V WHERE pval < 5e-6"""
    ),
)
def effect_summary_(spark, sf):
    return effect_summary(variants(spark, sf)).withColumn("mean_abs_effect", round_even(F.col("mean_abs_effect"), 9))


@query(
    "view_stats",
    with_v(
        """SELECT count(*) AS n_visible, count(*) FILTER (WHERE pval < 5e-8) AS n_gwas,
             (SELECT count(DISTINCT chr) FROM V) AS n_chromosomes,
             (SELECT variant_id FROM V WHERE pval < 1e-2 AND chr IN ('1', '21') ORDER BY pval, variant_id LIMIT 1) AS top_snp,
             min(pval) AS top_pval FROM V WHERE pval < 1e-2 AND chr IN ('1', '21')"""
    ),
)
def view_stats_(spark, sf):
    v = variants(spark, sf)
    return view_stats(v, logp_filter(chr_filter(v, ["1", "21"]), 2.0))


@query(
    "manhattan_points",
    with_v(
        f"""SELECT row_number() OVER (ORDER BY {CHR_RANK} NULLS LAST, chr NULLS LAST, pos, variant_id, pval) - 1 AS x,
              {rnd('-log10(greatest(pval, 1e-300))', 9)} AS y, chr, variant_id AS snp
            FROM V WHERE pval > 0 AND pval < 1"""
    ),
)
def manhattan_points_(spark, sf):
    return manhattan_points(variants(spark, sf)).withColumn("y", round_even(F.col("y"), 9))


@query(
    "manhattan_points_selected",
    with_v(
        f"""SELECT row_number() OVER (ORDER BY {CHR_RANK}, chr, pos, variant_id, pval) - 1 AS x,
              {rnd('-log10(greatest(pval, 1e-300))', 9)} AS y, chr, variant_id AS snp
            FROM V WHERE pval > 0 AND pval < 1e-2 AND chr IN ('2', '10')"""
    ),
)
def manhattan_points_selected(spark, sf):
    return manhattan_points(variants(spark, sf), ["2", "10"], 2.0).withColumn("y", round_even(F.col("y"), 9))


_QQ_SAMPLE = "(SELECT pval FROM V WHERE pval > 0 ORDER BY md5(concat_ws('|', '42', row_key)) LIMIT 10000)"


@query(
    "qq_points_sample",
    with_v(
        f"""SELECT i, {rnd('-log10(CAST(i AS DOUBLE) / (SELECT count(*) FROM s))', 9)} AS expected, {rnd('-log10(pval)', 9)} AS observed
            FROM (SELECT pval, row_number() OVER (ORDER BY pval) AS i FROM s) x""",
        f"s AS {_QQ_SAMPLE}",
        row_key=True,
    ),
)
def qq_points_sample(spark, sf):
    points = qq_points(variants(spark, sf, row_key=True), 10_000, ["row_key"])
    return points.select("i", round_even(F.col("expected"), 9).alias("expected"), round_even(F.col("observed"), 9).alias("observed"))


@query(
    "qq_points",
    with_v(
        f"""SELECT i, {rnd('-log10(CAST(i AS DOUBLE) / (SELECT count(*) FROM V WHERE pval > 0))', 9)} AS expected,
              {rnd('-log10(pval)', 9)} AS observed
            FROM (SELECT pval, row_number() OVER (ORDER BY pval) AS i FROM V WHERE pval > 0) x"""
    ),
)
def qq_points_(spark, sf):
    points = qq_points(variants(spark, sf))
    return points.select("i", round_even(F.col("expected"), 9).alias("expected"), round_even(F.col("observed"), 9).alias("observed"))


_BAND = "CASE WHEN l < 1.05 THEN 'Sin inflación' WHEN l < 1.1 THEN 'Inflación leve' ELSE 'Inflación significativa' END"


@query(
    "lambda_gc",
    with_v(
        f"""SELECT disorder, n, {rnd('l', 9)} AS lambda_gc, {_BAND} AS band
            FROM (SELECT disorder, count(*) AS n, quantile_cont(pval, 0.5) / 0.4549 AS l FROM V WHERE pval > 0 GROUP BY disorder) x"""
    ),
)
def lambda_gc_(spark, sf):
    out = lambda_gc(variants(spark, sf), "p_ratio", ["disorder"])
    return out.withColumn("lambda_gc", round_even(F.col("lambda_gc"), 9))


_CHI2 = "(" + " + ".join(chi2_from_p_sql(p) for p in ("lower_p", "upper_p")) + f") / 2 / {L.CHI2_MEDIAN_1DF}"


@query(
    "lambda_gc_chi2",
    with_v(
        f"""SELECT disorder, n, {rnd('l', 9)} AS lambda_gc, {_BAND} AS band
            FROM (SELECT disorder, n, {_CHI2} AS l
                  FROM (SELECT disorder, count(*) AS n, quantile_disc(pval, 0.5) AS lower_p, -quantile_disc(-pval, 0.5) AS upper_p
                        FROM V WHERE pval > 0 GROUP BY disorder) m) x"""
    ),
)
def lambda_gc_chi2(spark, sf):
    out = lambda_gc(variants(spark, sf), "chi2", ["disorder"])
    return out.withColumn("lambda_gc", round_even(F.col("lambda_gc"), 9))


_RENAMED = {
    "variant_id": "SNP", "chr": "CHROM", "pos": "BP", "pval": "P_VALUE", "effect_size": "BETA",
    "effect_kind": "EFFECT_TYPE", "se": "STDERR", "maf": "EAF", "disorder": "PHENOTYPE",
}


@query(
    "role_alias_rename",
    with_v("SELECT variant_id AS snp_id, chr, pos, pval, effect_size, effect_kind, se, maf, info, disorder FROM V"),
)
def role_alias_rename(spark, sf):
    return canonicalize(variants(spark, sf).withColumnsRenamed(_RENAMED))


@query(
    "chr_rank_counts",
    with_v(f"SELECT {CHR_RANK} AS chr_rank, count(*) AS n FROM V GROUP BY {CHR_RANK}"),
)
def chr_rank_counts(spark, sf):
    return variants(spark, sf).groupBy(chr_rank(F.col("chr")).alias("chr_rank")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "inflation_bands",
    f"SELECT band, count(*) AS n FROM (SELECT {_BAND} AS band FROM (SELECT l_extendedprice / 50000 AS l FROM lineitem) x) y GROUP BY band",
)
def inflation_bands(spark, sf):
    lam = F.col("l_extendedprice") / 50000
    return table(spark, sf, "lineitem").groupBy(inflation_band(lam).alias("band")).agg(F.count(F.lit(1)).alias("n"))
