"""Column profile, NULLs, value counts and the glossary."""

from __future__ import annotations

from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.catalogue.registry import pct, query, rnd, with_v
from assocframe.fixtures import table, variants
from assocframe.functions.scalars import round_even
from assocframe.operators.profile import (
    categorical_value_counts,
    column_glossary,
    column_profile,
    completeness,
    empty_columns,
    mode_value,
    null_patterns,
    null_profile,
    quality_kpis,
    row_null_rate,
    topk_share,
    type_counts,
    value_counts,
)
from assocframe.roles import non_numeric_columns, text_columns

_TYPES = {
    "variant_id": "string", "chr": "string", "pos": "bigint", "pval": "double", "effect_size": "double",
    "effect_kind": "string", "se": "double", "maf": "double", "info": "double", "disorder": "string",
}


def _profile_rows(by: str = "", distinct: bool = True) -> str:
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"""SELECT {lead}'{c}' AS "column", '{t}' AS type, count({c}) AS n_non_null, count(*) - count({c}) AS n_null,
              coalesce({pct(f'count(*) - count({c})', 'count(*)', 2)}, 0) AS pct_null
              {f', count(DISTINCT {c}) AS n_distinct' if distinct else ''} FROM V {group}"""
        for c, t in _TYPES.items()
        if c != by
    )


_STATUS = "CASE WHEN pct_null = 100 THEN 'Vacía (100%)' WHEN pct_null > 20 THEN 'Alta nulidad (>20%)' ELSE 'OK' END AS status"


@query("column_profile", with_v(f"SELECT *, {_STATUS} FROM ({_profile_rows()}) p"))
def column_profile_(spark, sf):
    return column_profile(variants(spark, sf))


@query("column_profile_by_disorder", with_v(f"SELECT *, {_STATUS} FROM ({_profile_rows('disorder')}) p"))
def column_profile_by_disorder(spark, sf):
    return column_profile(variants(spark, sf), ["disorder"])


@query("null_profile_by_disorder", with_v(_profile_rows("disorder", distinct=False)))
def null_profile_by_disorder(spark, sf):
    return null_profile(variants(spark, sf), ["disorder"])


def _kpis(source: str, lead: str = "") -> str:
    group = "GROUP BY disorder" if lead else ""
    return f"""SELECT {lead}count(*) AS n_columns, count(*) FILTER (WHERE n_non_null = 0) AS n_empty,
                 count(*) FILTER (WHERE pct_null > 20) AS n_high_null, count(*) FILTER (WHERE pct_null = 0) AS n_complete,
                 {rnd('avg(pct_null)', 1)} AS mean_pct_null FROM ({source}) p {group}"""


@query("quality_kpis", with_v(_kpis(_profile_rows(distinct=False))))
def quality_kpis_(spark, sf):
    return quality_kpis(variants(spark, sf))


@query("quality_kpis_by_disorder", with_v(_kpis(_profile_rows("disorder", distinct=False), "disorder, ")))
def quality_kpis_by_disorder(spark, sf):
    return quality_kpis(variants(spark, sf), ["disorder"])


@query(
    "completeness",
    with_v(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {rnd(f'CAST(count({c}) AS DOUBLE) / count(*) * 100', 6)} AS pct_complete FROM V"""
            for c in _TYPES
        )
    ),
)
def completeness_(spark, sf):
    return completeness(variants(spark, sf)).withColumn("pct_complete", round_even(F.col("pct_complete"), 6))


_MISSING = [f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _TYPES]


@query(
    "row_null_rate",
    with_v(
        f"""SELECT CAST(sum({' + '.join(_MISSING)}) AS BIGINT) AS n_null_cells,
              CAST({' + '.join(f'max({m})' for m in _MISSING)} AS INTEGER) AS n_null_columns,
              {pct(f"count(*) FILTER (WHERE {' + '.join(_MISSING)} > 0)", 'count(*)', 1)} AS pct_rows_with_null FROM V"""
    ),
)
def row_null_rate_(spark, sf):
    return row_null_rate(variants(spark, sf))


@query(
    "null_patterns",
    with_v(
        "SELECT *, count(*) AS n_rows FROM (SELECT "
        + ", ".join(f"CAST(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS INTEGER) AS {c}" for c in ("variant_id", "chr", "maf", "info"))
        + " FROM V) x GROUP BY ALL"
    ),
)
def null_patterns_(spark, sf):
    return null_patterns(variants(spark, sf), ["variant_id", "chr", "maf", "info"])


@query(
    "type_counts",
    with_v(f"SELECT type, count(*) AS n_columns FROM ({_profile_rows(distinct=False)}) p GROUP BY type"),
)
def type_counts_(spark, sf):
    return type_counts(variants(spark, sf))


@query("empty_columns", with_v(f'SELECT "column" FROM ({_profile_rows(distinct=False)}) p WHERE n_non_null = 0'))
def empty_columns_(spark, sf):
    return empty_columns(variants(spark, sf))


_BRANDS = "SELECT p_brand AS value, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY n DESC, value LIMIT 20"


@query("value_counts_topk", _BRANDS)
def value_counts_topk(spark, sf):
    return value_counts(table(spark, sf, "part"), "p_brand", 20)


@query(
    "topk_share",
    f"SELECT value, n, {pct('n', 'sum(n) OVER ()', 1)} AS pct_of_top FROM ({_BRANDS}) t",
)
def topk_share_(spark, sf):
    return topk_share(value_counts(table(spark, sf, "part"), "p_brand", 20))


@query(
    "mode_value",
    """WITH c AS (SELECT source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source)
       SELECT count(*) AS n_distinct, (SELECT value FROM c ORDER BY n DESC, value LIMIT 1) AS mode, max(n) AS mode_n
       FROM c""",
)
def mode_value_(spark, sf):
    return mode_value(table(spark, sf, "documents"), "source")


_EVENT_TEXTS = ("event_type", "props")


@query(
    "categorical_value_counts",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM events
            WHERE (SELECT count(DISTINCT {c}) FROM events) <= 500 AND {c} IS NOT NULL
            GROUP BY {c} ORDER BY n DESC, value LIMIT 20) t"""
        for c in _EVENT_TEXTS
    ),
)
def categorical_value_counts_(spark, sf):
    """Top values of every text column that has at most 500 distinct values."""
    events = table(spark, sf, "events")
    return categorical_value_counts(events, text_columns(events), 20, L.VALUE_COUNT_LIMIT)


@query(
    "column_kinds",
    """SELECT 'o_custkey' AS "column", 'number' AS kind, count(o_custkey) AS n_non_null FROM orders
       UNION ALL SELECT 'o_orderkey', 'number', count(o_orderkey) FROM orders
       UNION ALL SELECT 'o_totalprice', 'number', count(o_totalprice) FROM orders
       UNION ALL SELECT 'o_orderstatus', 'text', count(o_orderstatus) FROM orders
       UNION ALL SELECT 'o_orderpriority', 'text', count(o_orderpriority) FROM orders
       UNION ALL SELECT 'o_orderdate', 'other', count(o_orderdate) FROM orders""",
)
def column_kinds(spark, sf):
    orders = table(spark, sf, "orders")
    texts, others = text_columns(orders), non_numeric_columns(orders)
    kind = F.when(F.col("column").isin(*texts), "text").when(F.col("column").isin(*others), "other").otherwise("number")
    return null_profile(orders).select("column", kind.alias("kind"), "n_non_null")


#: A user's glossary: header in normal form and term.
_GLOSSARY = [("variant id", "Polymorphism"), ("chr", "Chromosome"), ("pos", "Locus"), ("effect size", "Effect size"), ("pval", "P-value")]


@query(
    "column_glossary",
    with_v(
        f"""SELECT p.*, coalesce(g.term, p.name_norm) AS term
            FROM (SELECT replace(replace(lower("column"), '_', ' '), '-', ' ') AS name_norm, "column", n_non_null
                  FROM ({_profile_rows(distinct=False)}) q) p
            LEFT JOIN (VALUES {', '.join(f"('{k}', '{v}')" for k, v in _GLOSSARY)}) g(name_norm, term)
            ON p.name_norm = g.name_norm"""
    ),
)
def column_glossary_(spark, sf):
    profile = null_profile(variants(spark, sf)).select("column", "n_non_null")
    return column_glossary(profile, spark.createDataFrame(_GLOSSARY, "name_norm string, term string"))
