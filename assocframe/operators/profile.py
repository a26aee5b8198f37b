"""Column profile and data quality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocframe import labels as L
from assocframe.functions.scalars import header_normal, null_band, percent, round_even
from assocframe.roles import col


def _present(field: T.StructField) -> Column:
    """True for a value; NaN in a float column is no value."""
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return col(field.name).isNotNull() & ~F.isnan(col(field.name))
    return col(field.name).isNotNull()


def _profiled(df: DataFrame, by: Sequence[str]) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in by]


def null_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``column, type, n_non_null, n_null, pct_null`` per column, in one pass."""
    return _counts(df, by, approx=False)


def _counts(df: DataFrame, by: Sequence[str], approx: bool) -> DataFrame:
    fields = _profiled(df, by)
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, field in enumerate(fields):
        aggregates.append(F.count_if(_present(field)).alias(f"_n{i}"))
        if approx:
            aggregates.append(F.approx_count_distinct(F.when(_present(field), col(field.name))).alias(f"_d{i}"))
    wide = df.groupBy(*[col(b) for b in by]).agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                col(f"_n{i}").alias("n_non_null"),
                (col("_rows") - col(f"_n{i}")).alias("n_null"),
                F.coalesce(percent(col("_rows") - col(f"_n{i}"), col("_rows"), 2), F.lit(0.0)).alias("pct_null"),
                *([col(f"_d{i}").alias("n_distinct")] if approx else []),
            )
            for i, field in enumerate(fields)
        ]
    )
    return wide.select(*[col(b) for b in by], F.inline(rows))


def _common_type(kind: T.DataType) -> str:
    """Type under which columns can share one long column without changing what is distinct."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    return "double" if isinstance(kind, (T.FloatType, T.DoubleType)) else "string"


def distinct_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact ``column, n_distinct``.

    Per kind of type, one narrow row per cell is made distinct before it is
    counted; numbers stay numbers.  Integers that lie close together are bits of
    bitmaps of 32,768 values instead, merged before they are shuffled.
    """
    groups: dict[str, list[T.StructField]] = {}
    for field in _profiled(df, by):
        groups.setdefault(_common_type(field.dataType), []).append(field)
    keys = [*by, "column"]
    counts = []
    for kind, fields in groups.items():
        cells = df.select(
            *[col(b) for b in by],
            *[F.when(_present(f), col(f.name).cast(kind)).alias(f.name) for f in fields],
        ).unpivot([col(b) for b in by], [col(f.name) for f in fields], "column", "value")
        cells = cells.filter(col("value").isNotNull())
        if kind == "bigint":
            # One row per column name.
            parted = cells.join(F.broadcast(_dense_columns(df, by, fields)), "column")
            counts.append(_count_bits(parted.filter("_dense"), keys))
            cells = parted.filter("not _dense").drop("_dense")
        counts.append(
            cells.distinct().groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_distinct"))
        )
    return reduce(DataFrame.unionByName, counts)


def _dense_columns(df: DataFrame, by: Sequence[str], fields: Sequence[T.StructField]) -> DataFrame:
    """``column, _dense``: whether bitmaps over a column's range are smaller than its cells.

    Every task may hold bitmaps of every group, a bit per value of the range,
    against 64 bits per cell.  What is estimated decides how cells travel only.
    """
    figures = [
        F.struct(
            F.lit(f.name).alias("column"),
            (F.max(col(f.name)).cast("double") - F.min(col(f.name)).cast("double") + 1.0).alias("range"),
            F.count(col(f.name)).alias("cells"),
        )
        for f in fields
    ]
    groups = F.approx_count_distinct(F.struct(*[col(b) for b in by])) if by else F.lit(1)
    placed = df.select(*[col(c) for c in [*by, *(f.name for f in fields)]], F.spark_partition_id().alias("_task"))
    told = placed.agg(F.array(*figures).alias("columns"), F.approx_count_distinct("_task").alias("tasks"), groups.alias("groups"))
    small = F.col("range") * F.col("tasks") * F.col("groups") <= 64.0 * F.col("cells")
    return told.select("tasks", "groups", F.inline("columns")).select("column", F.coalesce(small, F.lit(False)).alias("_dense"))


def _count_bits(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct integers per key by bitmaps."""
    bitmaps = cells.groupBy(*[col(k) for k in keys], F.bitmap_bucket_number("value").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("_bits")
    )
    return bitmaps.groupBy(*[col(k) for k in keys]).agg(F.sum(F.bitmap_count("_bits")).alias("n_distinct"))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def column_profile(df: DataFrame, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """``column, type, n_non_null, n_null, pct_null, n_distinct, status``, most NULLs first.

    ``exact=False`` estimates distinct values in the same pass as the counts
    and is the form for very large tables.
    """
    if exact:
        counts = _counts(df, by, approx=False).alias("c")
        distinct = distinct_counts(df, by).alias("d")
        keys = [*by, "column"]
        profile = counts.join(distinct, _same(counts, distinct, keys), "left").select(
            "c.*", F.coalesce(F.col("d.n_distinct"), F.lit(0)).alias("n_distinct")
        )
    else:
        profile = _counts(df, by, approx=True)
    return profile.withColumn("status", null_band(col("pct_null"))).orderBy(*by, F.desc("pct_null"), "column")


def empty_columns(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Columns without a single value."""
    return null_profile(df, by).filter(col("n_non_null") == 0).select(*[col(b) for b in by], "column")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    empty = {r["column"] for r in empty_columns(df).collect()}
    return df.select(*[col(c) for c in df.columns if c not in empty])


def type_counts(df: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Number of columns per type."""
    profile = null_profile(df) if profile is None else profile
    return profile.groupBy("type").agg(F.count(F.lit(1)).alias("n_columns")).orderBy(F.desc("n_columns"), "type")


def quality_kpis(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Columns in all, empty, above the null limit, complete; mean null percent."""
    return (
        null_profile(df, by)
        .groupBy(*[col(b) for b in by])
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.count_if(col("n_non_null") == 0).alias("n_empty"),
            F.count_if(col("pct_null") > L.HIGH_NULL_PCT).alias("n_high_null"),
            F.count_if(col("pct_null") == 0).alias("n_complete"),
            round_even(F.avg("pct_null"), 1).alias("mean_pct_null"),
        )
    )


def completeness(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Percent of rows with a value, lowest first."""
    share = col("n_non_null") / F.nullif(col("n_non_null") + col("n_null"), F.lit(0)) * 100.0
    return (
        null_profile(df, by)
        .select(*[col(b) for b in by], "column", share.alias("pct_complete"))
        .orderBy(*by, "pct_complete", "column")
    )


def row_null_rate(df: DataFrame) -> DataFrame:
    """NULL cells, columns with NULLs, and percent of rows with any NULL."""
    fields = df.schema.fields
    missing = [~_present(f) for f in fields]
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    cells = sum((F.sum(m.cast("int")) for m in missing[1:]), F.sum(missing[0].cast("int")))
    columns = sum((F.max(m.cast("int")) for m in missing[1:]), F.max(missing[0].cast("int")))
    return df.agg(
        cells.cast("bigint").alias("n_null_cells"),
        columns.cast("int").alias("n_null_columns"),
        percent(F.count_if(any_missing), F.count(F.lit(1)), 1).alias("pct_rows_with_null"),
    )


def null_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per pattern of missing cells: 0/1 per column (1: missing), and ``n_rows``.

    This is the null matrix with equal rows put together, over the whole table.
    """
    fields = {f.name: f for f in df.schema.fields}
    marks = [(~_present(fields[c])).cast("int").alias(c) for c in (columns or df.columns)]
    named = df.select(*marks)
    return named.groupBy(*[col(c) for c in named.columns]).agg(F.count(F.lit(1)).alias("n_rows"))


def value_counts(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent values, NULL out."""
    return (
        df.filter(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(k)
    )


def topk_share(top: DataFrame) -> DataFrame:
    """Percent of each value among the values shown, not of the table."""
    # The window sees the k rows of a top list.
    return top.withColumn("pct_of_top", percent(col("n"), F.sum("n").over(Window.partitionBy()), 1))


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, most frequent value and its count."""
    counts = (
        df.filter(col(column).isNotNull())
        .groupBy(col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.min_by("value", F.struct(-col("n"), col("value"))).alias("mode"),
        F.max("n").alias("mode_n"),
    )


def categorical_value_counts(df: DataFrame, columns: Sequence[str], k: int, limit: int) -> DataFrame:
    """The ``k`` most frequent values of each of ``columns`` that has at most ``limit`` distinct ones.

    One scan in long form; what is ranked has at most ``limit`` rows per column.
    """
    named = df.select(*[col(c).cast("string").alias(c) for c in columns])
    long = named.unpivot([], [col(c) for c in columns], "column", "value").filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # Columns of too many values are known from one count per column, so no window gathers their values.
    few = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct")).filter(col("distinct") <= limit)
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    kept = counts.join(F.broadcast(few.select("column")), "column")  # one row per column name
    return kept.withColumn("place", place).filter(col("place") <= k).drop("place")


def column_glossary(profile: DataFrame, glossary: DataFrame) -> DataFrame:
    """Term per column; a header that is not in the glossary stands for itself."""
    named = profile.withColumn("name_norm", header_normal(col("column")))
    # A profile has one row per column, so the glossary is broadcast by Spark only if it is small.
    return named.join(glossary, "name_norm", "left").withColumn("term", F.coalesce("term", "name_norm"))
