"""Quantiles, outliers, histograms, correlation and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from assocframe.catalogue.registry import pct, query, rnd, with_v
from assocframe.fixtures import table, variants
from assocframe.functions.scalars import round_even
from assocframe.operators.correlation import (
    collinear_pairs,
    correlatable_columns,
    correlation,
    correlation_matrix,
    pivot_matrix,
    threshold_correlation,
    top_pairs,
    variance_topk,
)
from assocframe.operators.filters import association_filter, fill_constants
from assocframe.operators.quantiles import (
    box_stats,
    density_curve,
    describe,
    exact_quantiles,
    histogram,
    iqr_outliers,
    outlier_rows,
    sampled_iqr_outliers,
    violin,
)
from assocframe.operators.sampling import (
    impute_uniform,
    pval_maf_points,
    pvalue_sample_per_disorder,
    sample_exact,
    sample_proportional,
    scatter_points,
)
from assocframe.sources.load import block_sample, load, scan

_LINE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_V_NUMBERS = ("pos", "pval", "effect_size", "se", "maf")


def _rounded(df, digits, *columns):
    for c in columns:
        df = df.withColumn(c, round_even(F.col(c), digits))
    return df


# Quantiles and describe -----------------------------------------------------------


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {rnd(f'avg({c})', 4)} AS mean, {rnd(f'stddev_samp({c})', 4)} AS std,
              {rnd(f'min({c})', 4)} AS min, {rnd(f'quantile_cont({c}, 0.25)', 4)} AS p25, {rnd(f'quantile_cont({c}, 0.5)', 4)} AS p50,
              {rnd(f'quantile_cont({c}, 0.75)', 4)} AS p75, {rnd(f'max({c})', 4)} AS max FROM lineitem"""
        for c in _LINE
    ),
)
def describe_numeric(spark, sf):
    return describe(table(spark, sf, "lineitem"), _LINE)


_QS = (0.01, 0.25, 0.5, 0.75, 0.99)


def _quantile_rows(source: str, columns, by: str = "") -> str:
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"""SELECT {lead}'{c}' AS "column", CAST({q} AS DOUBLE) AS q, {rnd(f'quantile_cont(CAST({c} AS DOUBLE), {q})', 9)} AS value FROM {source} {group}"""
        for c in columns
        for q in _QS
    )


@query("quantiles", _quantile_rows("orders", ["o_totalprice", "o_custkey"]))
def quantiles(spark, sf):
    return _rounded(exact_quantiles(table(spark, sf, "orders"), ["o_totalprice", "o_custkey"], _QS), 9, "value")


@query("quantiles_bracket", _quantile_rows("lineitem", _LINE))
def quantiles_bracket(spark, sf):
    """Four columns at once."""
    out = exact_quantiles(table(spark, sf, "lineitem"), _LINE, _QS)
    return _rounded(out, 9, "value")


@query("quantiles_by_disorder", with_v(_quantile_rows("V", ["pval", "maf"], "disorder")))
def quantiles_by_disorder(spark, sf):
    return _rounded(exact_quantiles(variants(spark, sf), ["pval", "maf"], _QS, ["disorder"]), 9, "value")


# Outliers and boxes ---------------------------------------------------------------


def _limits(source: str, column: str, by: str = "") -> str:
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    q1, q2, q3 = (f"quantile_cont(CAST({column} AS DOUBLE), {q})" for q in (0.25, 0.5, 0.75))
    return f"""SELECT {lead}count({column}) AS n, {q1} AS q1, {q2} AS q2, {q3} AS q3,
                 {q1} - 1.5 * ({q3} - {q1}) AS low, {q3} + 1.5 * ({q3} - {q1}) AS high FROM {source} {group}"""


def _outliers(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) FILTER (WHERE x < low OR x > high) AS n_outliers,
                 {pct('count(*) FILTER (WHERE x < low OR x > high)', 'count(*)', 2)} AS pct_outliers,
                 min(x) AS min, max(x) AS max, {rnd('any_value(low)', 6)} AS low, {rnd('any_value(high)', 6)} AS high
               FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source} WHERE {column} IS NOT NULL) v,
                    ({_limits(source, column)}) l HAVING count(*) >= 10"""


@query("iqr_outliers", with_v(" UNION ALL ".join(_outliers("V", c) for c in _V_NUMBERS)))
def iqr_outliers_(spark, sf):
    return _rounded(iqr_outliers(variants(spark, sf), _V_NUMBERS, drop_zero=False), 6, "low", "high")


_EVENTS_OUT = _outliers("events", "value")


@query("iqr_outliers_nonzero", f"SELECT * FROM ({_EVENTS_OUT} UNION ALL {_outliers('events', 'user_id')}) o WHERE n_outliers > 0")
def iqr_outliers_nonzero(spark, sf):
    return _rounded(iqr_outliers(table(spark, sf, "events"), ["value", "user_id"]), 6, "low", "high")


@query(
    "outlier_rows",
    f"""SELECT event_id, user_id, event_type, value FROM events, ({_limits('events', 'value')}) l
        WHERE value < low OR value > high""",
)
def outlier_rows_(spark, sf):
    return outlier_rows(table(spark, sf, "events"), "value").select("event_id", "user_id", "event_type", "value")


_KEYED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_LINE_HASH = "md5(concat_ws('|', '42', l_orderkey, l_partkey, l_suppkey, l_linenumber))"


@query(
    "sampled_iqr_outliers",
    f"""WITH s AS (SELECT l_extendedprice AS x FROM lineitem ORDER BY {_LINE_HASH} LIMIT 50000),
             r AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS i, count(*) OVER () AS n FROM s WHERE x IS NOT NULL),
             q AS (SELECT max(CASE WHEN i = floor(0.25 * (n - 1) + 0.5) THEN x END) AS q1,
                          max(CASE WHEN i = floor(0.75 * (n - 1) + 0.5) THEN x END) AS q3 FROM r),
             l AS (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
        SELECT (SELECT count(*) FROM lineitem, l WHERE l_extendedprice < low OR l_extendedprice > high) AS n_outliers,
               {rnd('low', 6)} AS low, {rnd('high', 6)} AS high FROM l""",
)
def sampled_iqr_outliers_(spark, sf):
    out = sampled_iqr_outliers(table(spark, sf, "lineitem"), "l_extendedprice", 50_000, key=_KEYED)
    return _rounded(out, 6, "low", "high")


def _box(source: str, column: str, label: str, by: str = "") -> str:
    lead = f"l.{by}, " if by else ""
    join = f"v.{by} = l.{by}" if by else "TRUE"
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {lead}'{label}' AS "column", n, {rnd('q1', 6)} AS q1, {rnd('q2', 6)} AS q2, {rnd('q3', 6)} AS q3,
                 {rnd('min(CASE WHEN x BETWEEN low AND high THEN x END)', 6)} AS whisker_low,
                 {rnd('max(CASE WHEN x BETWEEN low AND high THEN x END)', 6)} AS whisker_high,
                 count(*) FILTER (WHERE x < low OR x > high) AS n_outliers
               FROM (SELECT *, CAST({column} AS DOUBLE) AS x FROM {source} WHERE {column} IS NOT NULL) v
               JOIN ({_limits(source, column, by)}) l ON {join} GROUP BY {lead}n, q1, q2, q3"""


_BOX_NUMBERS = ("q1", "q2", "q3", "whisker_low", "whisker_high")


@query("box_stats", with_v(_box("V", "pval", "pval", "disorder")))
def box_stats_(spark, sf):
    return _rounded(box_stats(variants(spark, sf), "pval", ["disorder"]), 6, *_BOX_NUMBERS)


@query(
    "box_stats_log1p",
    f"WITH O AS (SELECT ln(1 + greatest(o_totalprice, 0)) AS v FROM orders) {_box('O', 'v', 'log1p(o_totalprice)')}",
)
def box_stats_log1p(spark, sf):
    return _rounded(box_stats(table(spark, sf, "orders"), "o_totalprice", log1p=True), 6, *_BOX_NUMBERS)


# Histograms -----------------------------------------------------------------------


def _hist(source: str, column: str, bins: int, by: str = "", label: str = "", density: bool = False) -> str:
    lead, over = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    more = f", {rnd(f'CAST(count(*) AS DOUBLE) / (any_value(total) * ((hi - lo) / {bins}))', 6)} AS density" if density else ""
    return f"""SELECT {lead}'{label or column}' AS "column", CAST(b AS INTEGER) AS bin, {rnd(f'lo + b * ((hi - lo) / {bins})', 6)} AS bin_low,
                 {rnd(f'lo + (b + 1) * ((hi - lo) / {bins})', 6)} AS bin_high, count(*) AS n{more}
               FROM (SELECT *, least(coalesce(floor((x - lo) / NULLIF(hi - lo, 0) * {bins}), 0), {bins - 1}) AS b
                     FROM (SELECT *, min(x) OVER ({over}) AS lo, max(x) OVER ({over}) AS hi, count(*) OVER ({over}) AS total
                           FROM (SELECT *, CAST({column} AS DOUBLE) AS x FROM {source} WHERE {column} IS NOT NULL) a) c) d
               GROUP BY {lead}b, lo, hi"""


def _hist_out(df, density: bool = False):
    return _rounded(df, 6, "bin_low", "bin_high", *(["density"] if density else []))


@query(
    "hist_logp",
    with_v(_hist("P", "neg_log10_p", 80), "P AS (SELECT -log10(pval) AS neg_log10_p FROM V WHERE pval > 0)"),
)
def hist_logp(spark, sf):
    logp = variants(spark, sf).filter("pval > 0").select((-F.log10("pval")).alias("neg_log10_p"))
    return _hist_out(histogram(logp, ["neg_log10_p"], 80))


@query("hist_numeric", " UNION ALL ".join(_hist("lineitem", c, 40) for c in _LINE))
def hist_numeric(spark, sf):
    return _hist_out(histogram(table(spark, sf, "lineitem"), _LINE, 40))


@query(
    "hist_effect",
    with_v(
        _hist("S", "effect_size", 20),
        "S AS (SELECT effect_size FROM V WHERE disorder = 'bpd' AND pval < 5e-6 AND abs(effect_size) > 0.1)",
    ),
)
def hist_effect(spark, sf):
    return _hist_out(histogram(association_filter(variants(spark, sf), "bpd", 5e-6, 0.1), ["effect_size"], 20))


_LOGP = "s AS (SELECT disorder, -log10(pval) AS neg_log10_p FROM V WHERE pval > 0)"
_VIOLIN = (
    "SELECT h.*, n_values, q1, q2, q3, whisker_low, whisker_high, n_outliers FROM ("
    + _hist("s", "neg_log10_p", 40, "disorder", density=True)
    + ") h JOIN (SELECT * RENAME (n AS n_values) FROM ("
    + _box("s", "neg_log10_p", "neg_log10_p", "disorder")
    + ")) b ON h.disorder = b.disorder"
)


@query("violin_by_disorder", with_v(_VIOLIN, _LOGP))
def violin_by_disorder(spark, sf):
    """Density and box of all p-values of every disorder."""
    logp = variants(spark, sf).filter("pval > 0").select("disorder", (-F.log10("pval")).alias("neg_log10_p"))
    return _rounded(_hist_out(violin(logp, "neg_log10_p", ["disorder"]), density=True), 6, *_BOX_NUMBERS)


_CURVE = """f AS (SELECT disorder, count(*) AS n, stddev_samp(neg_log10_p) * count(*) ** -0.2 AS bandwidth, min(neg_log10_p) AS lo, max(neg_log10_p) AS hi
      FROM s GROUP BY disorder),
  g AS (SELECT *, lo - 2 * bandwidth AS low, (hi - lo + 4 * bandwidth) / 256 AS step FROM f WHERE bandwidth > 0),
  b AS (SELECT disorder, (neg_log10_p - low) / step AS place, floor((neg_log10_p - low) / step) AS cell FROM s JOIN g USING (disorder)),
  w AS (SELECT disorder, i, sum(w) AS w FROM (SELECT disorder, cell AS i, cell + 1 - place AS w FROM b
      UNION ALL SELECT disorder, cell + 1, place - cell FROM b) u GROUP BY disorder, i),
  x AS (SELECT *, low + p * (step * 256 / 79) AS x FROM g, range(80) r(p))"""


@query(
    "violin_density",
    with_v(
        f"""SELECT disorder, any_value(n) AS n, {rnd('any_value(bandwidth)', 6)} AS bandwidth, {rnd('x', 6)} AS x,
              {rnd('sum(w * exp(-0.5 * ((x - low - i * step) / bandwidth) ** 2)) / any_value(n * bandwidth * sqrt(2 * pi()))', 6)} AS density
            FROM x JOIN w USING (disorder) GROUP BY disorder, x""",
        f"{_LOGP}, {_CURVE}",
    ),
)
def violin_density(spark, sf):
    """The smooth outline of each disorder's violin."""
    logp = variants(spark, sf).filter("pval > 0").select("disorder", (-F.log10("pval")).alias("neg_log10_p"))
    return _rounded(density_curve(logp, "neg_log10_p", ["disorder"], points=80, bins=256), 6, "bandwidth", "x", "density")


_PER_DISORDER = """s AS (SELECT disorder, -log10(pval) AS neg_log10_p FROM (SELECT *, row_number() OVER (PARTITION BY disorder
    ORDER BY md5(concat_ws('|', '42', row_key))) AS rn FROM V WHERE pval > 0) x WHERE rn <= 5000)"""


# Correlation ----------------------------------------------------------------------


def _matrix(source: str, columns, r) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(r(a, b), 9)} AS r FROM {source}"
        if a != b
        else f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(1 AS DOUBLE) AS r"
        for a in columns
        for b in columns
    )


def _pair_rows(source: str, columns, r) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(a, b)} AS r FROM {source}"
        for i, a in enumerate(columns)
        for b in columns[i + 1:]
    )


_COMPLETE_V = "C AS (SELECT * FROM V WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _V_NUMBERS) + ")"


@query("pearson_matrix", with_v(_matrix("C", _V_NUMBERS, lambda a, b: f"corr({a}, {b})"), _COMPLETE_V))
def pearson_matrix(spark, sf):
    v = variants(spark, sf)
    columns = correlatable_columns(v)
    return _rounded(correlation_matrix(correlation(v, columns), columns), 9, "r")


@query(
    "pearson_pivot",
    with_v(
        " UNION ALL ".join(
            f"SELECT '{a}' AS col_a, "
            + ", ".join(f"{'CAST(1 AS DOUBLE)' if a == b else rnd(f'corr({a}, {b})', 9)} AS {b}" for b in _V_NUMBERS)
            + " FROM C"
            for a in _V_NUMBERS
        ),
        _COMPLETE_V,
    ),
)
def pearson_pivot(spark, sf):
    v = variants(spark, sf)
    square = pivot_matrix(correlation_matrix(correlation(v, _V_NUMBERS), _V_NUMBERS), _V_NUMBERS)
    return _rounded(square, 9, *_V_NUMBERS)


_RANKS = "R AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _LINE
) + " FROM lineitem)"


@query("spearman_matrix", f"WITH {_RANKS} {_matrix('R', _LINE, lambda a, b: f'corr({a}, {b})')}")
def spearman_matrix(spark, sf):
    pairs = correlation(table(spark, sf, "lineitem"), _LINE, "spearman")
    return _rounded(correlation_matrix(pairs, _LINE), 9, "r")


_PART = ("p_partkey", "p_size", "p_retailprice")


def _tau(a: str, b: str) -> str:
    return (
        f"(SELECT sum(sign(CAST(x.{a} AS DOUBLE) - y.{a}) * sign(CAST(x.{b} AS DOUBLE) - y.{b})) "
        f"/ (sqrt(count(*) FILTER (WHERE x.{a} <> y.{a})) * sqrt(count(*) FILTER (WHERE x.{b} <> y.{b}))) "
        f"FROM part x JOIN part y ON x.p_partkey < y.p_partkey)"
    )


@query(
    "kendall_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {'CAST(1 AS DOUBLE)' if a == b else rnd(_tau(a, b), 9)} AS r"
        for a in _PART
        for b in _PART
    ),
)
def kendall_matrix(spark, sf):
    pairs = correlation(table(spark, sf, "part"), _PART, "kendall")
    return _rounded(correlation_matrix(pairs, _PART), 9, "r")


def _tau_of_counts(x: str, y: str) -> str:
    """Kendall's tau-b of lineitem columns of which y has few values: running counts per value of y along x."""
    ties = "(SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM lineitem GROUP BY {}) t)"
    free = "sqrt((SELECT count(*) * (count(*) - 1) / 2 FROM lineitem) - {})"
    return f"""(WITH c AS (SELECT {x} AS x, {y} AS y, count(*) AS n FROM lineitem GROUP BY ALL),
      g AS (SELECT x, y, coalesce(n, 0) AS n FROM (SELECT DISTINCT x FROM c) a CROSS JOIN (SELECT DISTINCT y FROM c) b LEFT JOIN c USING (x, y)),
      h AS (SELECT x, y, n, coalesce(sum(n) OVER (PARTITION BY y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
      k AS (SELECT n, before, sum(before) OVER (PARTITION BY x) AS every,
              coalesce(sum(before) OVER (PARTITION BY x ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h)
      SELECT sum(n * (2 * below + before - every)) / ({free.format(ties.format(x))} * {free.format(ties.format(y))}) FROM k)"""


@query(
    "kendall_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(_tau_of_counts(*((b, a) if b == 'l_extendedprice' else (a, b))), 9)} AS r"
        for i, a in enumerate(_LINE)
        for b in _LINE[i + 1:]
    ),
)
def kendall_pairs(spark, sf):
    """All rows of lineitem, one column of which has hardly any ties."""
    return _rounded(correlation(table(spark, sf, "lineitem"), _LINE, "kendall"), 9, "r")


_LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_LINE)


@query(
    "corr_thresholded",
    f"""SELECT col_a, col_b, CASE WHEN abs(r) < 0.005 THEN 0 ELSE {rnd('r', 9)} END AS r
        FROM ({_pair_rows('lineitem', _LINE_NUMBERS, lambda a, b: f'corr({a}, {b})')}) p""",
)
def corr_thresholded(spark, sf):
    pairs = correlation(table(spark, sf, "lineitem"), _LINE_NUMBERS)
    return _rounded(threshold_correlation(pairs, 0.005), 9, "r")


@query(
    "corr_top_pairs",
    f"""SELECT col_a, col_b, {rnd('r', 4)} AS r, {rnd('abs(r)', 4)} AS abs_r
        FROM ({_pair_rows('lineitem', _LINE_NUMBERS, lambda a, b: f'corr({a}, {b})')}) p
        ORDER BY abs_r DESC, col_a, col_b LIMIT 30""",
)
def corr_top_pairs(spark, sf):
    return top_pairs(correlation(table(spark, sf, "lineitem"), _LINE_NUMBERS), 30)


@query(
    "corr_top_pairs_signed",
    f"""SELECT col_a, col_b, {rnd('r', 9)} AS r
        FROM ({_pair_rows('lineitem', _LINE_NUMBERS, lambda a, b: f'corr({a}, {b})')}) p ORDER BY p.r DESC LIMIT 5""",
)
def corr_top_pairs_signed(spark, sf):
    pairs = correlation(table(spark, sf, "lineitem"), _LINE_NUMBERS)
    return _rounded(top_pairs(pairs, 5, signed=True), 9, "r")


@query(
    "collinear_pairs",
    f"""SELECT col_a, col_b, {rnd('r', 9)} AS r
        FROM ({_pair_rows('part', _PART, lambda a, b: f'corr({a}, {b})')}) p WHERE abs(r) > 0.85""",
)
def collinear_pairs_(spark, sf):
    return _rounded(collinear_pairs(correlation(table(spark, sf, "part"), _PART)), 9, "r")


@query(
    "variance_topk",
    "SELECT * FROM ("
    + " UNION ALL ".join(f"""SELECT '{c}' AS "column", {rnd(f'var_samp({c})', 4)} AS variance FROM lineitem""" for c in _LINE_NUMBERS)
    + ") v ORDER BY variance DESC LIMIT 5",
)
def variance_topk_(spark, sf):
    return _rounded(variance_topk(table(spark, sf, "lineitem"), 5), 4, "variance")


# Samples --------------------------------------------------------------------------

_V_HASH = "md5(concat_ws('|', '42', row_key))"


@query("sample_exact_n", with_v(f"SELECT * FROM V ORDER BY {_V_HASH} LIMIT 10000", row_key=True))
def sample_exact_n(spark, sf):
    return sample_exact(variants(spark, sf, row_key=True), 10_000, ["row_key"])


@query(
    "sample_proportional",
    with_v(
        f"""SELECT * EXCLUDE (rn, total) FROM (SELECT *, row_number() OVER (PARTITION BY disorder, chr ORDER BY {_V_HASH}) AS rn,
              count(*) OVER (PARTITION BY disorder, chr) AS total FROM V) x
            WHERE rn <= greatest(1, floor(total * (5000.0::DOUBLE / (SELECT count(*) FROM V))))""",
        row_key=True,
    ),
)
def sample_proportional_(spark, sf):
    return sample_proportional(variants(spark, sf, row_key=True), 5_000, ["disorder", "chr"], ["row_key"])


@query(
    "sample_by_block",
    f"""SELECT l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (ORDER BY {_LINE_HASH}) AS rn, count(*) OVER () AS total
          FROM lineitem) x WHERE rn <= greatest(1, floor(total * (4000.0::DOUBLE / total)))""",
)
def sample_by_block(spark, sf):
    lineitem = scan(spark, f"{sf}/lineitem.parquet")
    return block_sample(lineitem, ["l_orderkey", "l_extendedprice"], 4_000, _KEYED)


@query(
    "sample_capped_scan",
    f"SELECT *, 'lineitem.parquet' AS source_file FROM lineitem ORDER BY {_LINE_HASH} LIMIT 5000",
)
def sample_capped_scan(spark, sf):
    path = f"{sf}/lineitem.parquet"
    return load(spark, path, mode="sample", cap=5_000, key=_KEYED).df


@query("sample_per_group", with_v(f"SELECT disorder, {rnd('neg_log10_p', 9)} AS neg_log10_p FROM s", _PER_DISORDER, row_key=True))
def sample_per_group_(spark, sf):
    sample = pvalue_sample_per_disorder(variants(spark, sf, row_key=True), 5_000, key=["row_key"])
    return _rounded(sample, 9, "neg_log10_p")


@query(
    "scatter_extract",
    with_v("SELECT maf, pval FROM V WHERE maf IS NOT NULL AND pval IS NOT NULL"),
)
def scatter_extract(spark, sf):
    return scatter_points(variants(spark, sf), ["maf", "pval"])


@query(
    "scatter_extract_sample",
    with_v(f"SELECT maf, pval FROM V WHERE maf IS NOT NULL AND pval IS NOT NULL ORDER BY {_V_HASH} LIMIT 15000", row_key=True),
)
def scatter_extract_sample(spark, sf):
    return scatter_points(variants(spark, sf, row_key=True), ["maf", "pval"], 15_000, ["row_key"])


@query(
    "scatter_pval_maf",
    with_v("SELECT maf, coalesce(pval, 1) AS pval FROM V WHERE maf IS NOT NULL"),
)
def scatter_pval_maf(spark, sf):
    return pval_maf_points(variants(spark, sf))


@query(
    "impute_uniform_flagged",
    with_v(
        f"""SELECT row_key, maf IS NULL AS is_imputed, {rnd(f"coalesce(maf, 0.01 + (0.5 - 0.01) * (CAST('0x' || left({_V_HASH}, 12) AS BIGINT) / 281474976710656.0::DOUBLE))", 9)} AS maf FROM V""",
        row_key=True,
    ),
)
def impute_uniform_flagged(spark, sf):
    out = impute_uniform(variants(spark, sf, row_key=True), "maf", ["row_key"])
    return _rounded(out.select("row_key", "is_imputed", "maf"), 9, "maf")


@query(
    "fill_constants",
    with_v("SELECT variant_id, pos, coalesce(chr, '—') AS chr, coalesce(maf, 0) AS maf, coalesce(info, 1) AS info FROM V"),
)
def fill_constants_(spark, sf):
    return fill_constants(variants(spark, sf).select("variant_id", "pos", "chr", "maf", "info"), {"chr": "—", "maf": 0.0, "info": 1.0})
