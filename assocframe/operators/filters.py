"""Filters and projections of variant tables and of tables in general."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocframe import labels as L
from assocframe.functions.scalars import rsid_normal
from assocframe.plans.ordering import global_row_number
from assocframe.roles import Roles, col, roles_of


def level_filter(df: DataFrame, level: float, roles: Roles | None = None) -> DataFrame:
    """``p < level``; level 1.0 keeps every row, NULL p included."""
    if level >= 1.0:
        return df
    r = roles_of(df, roles)
    r.need("pval")
    return df.filter(col(r.pval) < F.lit(level))


def logp_filter(df: DataFrame, min_logp: float, roles: Roles | None = None) -> DataFrame:
    """``p < 10 ** -min_logp``."""
    r = roles_of(df, roles)
    r.need("pval")
    return df.filter(col(r.pval) < F.lit(10.0 ** -min_logp))


def chr_filter(df: DataFrame, chroms: Sequence[str] | None, roles: Roles | None = None) -> DataFrame:
    """Rows on the given chromosomes; none given means all."""
    if not chroms:
        return df
    r = roles_of(df, roles)
    r.need("chr")
    return df.filter(col(r.chr).cast("string").isin(*[str(c) for c in chroms]))


def association_filter(
    df: DataFrame,
    disorder: str | None = None,
    level: float | None = None,
    min_abs_effect: float | None = None,
    roles: Roles | None = None,
) -> DataFrame:
    """Disorder, p-value and absolute effect in one conjunction."""
    r = roles_of(df, roles)
    if disorder is not None:
        r.need("disorder")
        df = df.filter(col(r.disorder) == disorder)
    if level is not None:
        r.need("pval")
        df = df.filter(col(r.pval) < F.lit(level))
    if min_abs_effect is not None:
        r.need("effect")
        df = df.filter(F.abs(col(r.effect)) > F.lit(min_abs_effect))
    return df


def clean_pvalues(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Rows with a p-value above zero."""
    r = roles_of(df, roles)
    r.need("pval")
    return df.filter(col(r.pval) > 0)


def range_filter(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Both ends included, NULLs out; a missing end is open."""
    keep = col(column).isNotNull()
    if low is not None:
        keep = keep & (col(column) >= F.lit(low))
    if high is not None:
        keep = keep & (col(column) <= F.lit(high))
    return df.filter(keep)


def category_filter(df: DataFrame, column: str, values: Sequence | None = None) -> DataFrame:
    """Rows with one of ``values``, or with any value; NULLs out."""
    if values is None:
        return df.filter(col(column).isNotNull())
    return df.filter(col(column).isin(*values))


def text_filter(df: DataFrame, column: str, text: str | None, literal: bool = False) -> DataFrame:
    """Case-insensitive regular expression (or literal text) anywhere in the column.

    NULL never matches; empty text keeps every row.
    """
    if not text:
        return df
    value = col(column).cast("string")
    if literal:
        return df.filter(F.contains(F.lower(value), F.lit(text.lower())))
    return df.filter(value.rlike("(?i)" + text))


def filter_kind(df: DataFrame, column: str, category_limit: int = L.CATEGORY_LIMIT) -> str:
    """Which filter to offer for a column: ``range``, ``category`` or ``text``, by type and number of distinct values."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        return "range"
    distinct = df.agg(F.count_distinct(col(column))).first()[0]
    return "category" if distinct < category_limit else "text"


def typed_filter(
    df: DataFrame, column: str, low=None, high=None, values: Sequence | None = None, text: str | None = None
) -> DataFrame:
    """The filter of the argument given: a range, values or a text; with none, rows that have a value."""
    given = [low is not None or high is not None, values is not None, text is not None]
    if sum(given) > 1:
        raise ValueError("give a range, values or a text, not several of them")
    kind = df.schema[column].dataType
    if given[0]:
        if isinstance(kind, (T.StringType, T.BooleanType)) and isinstance(low if low is not None else high, (int, float)):
            raise ValueError(f"column {column} holds no numbers")
        return range_filter(df, column, low, high)
    if given[2]:
        if isinstance(kind, T.NumericType):
            raise ValueError(f"column {column} holds numbers, not text")
        return text_filter(df, column, text)
    return category_filter(df, column, values)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in all of ``columns``."""
    for c in df.columns if columns is None else columns:
        df = df.filter(col(c).isNotNull())
    return df


def association_columns(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Id, chromosome, position, p, effect, SE and MAF, as far as present."""
    r = roles_of(df, roles)
    wanted = (r.snp, r.chr, r.pos, r.pval, r.effect, r.se, r.maf)
    return df.select(*[col(c) for c in dict.fromkeys(wanted) if c is not None])


def rsid_list(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Distinct ids that start with ``rs`` in any case, sorted; the case is kept."""
    r = roles_of(df, roles)
    r.need("snp")
    ids = df.select(col(r.snp).cast("string").alias("snp"))
    return ids.filter(F.lower("snp").startswith("rs")).distinct().orderBy("snp")


def rsid_column(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Adds ``rsid``, the id in normal form or NULL."""
    r = roles_of(df, roles)
    r.need("snp")
    return df.withColumn("rsid", rsid_normal(col(r.snp)))


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Preview of ``n`` rows: Spark rows have no order of their own, so one must be named."""
    return df.orderBy(*[col(c) for c in order]).limit(n)


def rows_indexed(df: DataFrame, order: Sequence[str], column: str, n: int | None = None) -> DataFrame:
    """``index, value`` of one column in the given order, of all rows or of the first ``n``."""
    rows = df.select(*[col(c) for c in dict.fromkeys([*order, column])])
    if n is not None:
        rows = first_rows(rows, order, n)
    numbered = global_row_number(rows, [col(c).asc() for c in order], "index", start=0)
    return numbered.select(col("index").cast("bigint").alias("index"), col(column).alias("value"))


def fill_constants(df: DataFrame, fills: dict) -> DataFrame:
    """NULL replaced by a constant per column."""
    filled = {c: F.coalesce(col(c), F.lit(v)) for c, v in fills.items()}
    return df.select(*[filled[c].alias(c) if c in filled else col(c) for c in df.columns])
