"""The significant subset, written once and read back by chromosome, level or id.

Loci, annotations and plots start from this subset again and again.  It is laid
out for them: a folder per chromosome, rows in order of p inside it and over the
tasks, and Parquet Bloom filters on the id.  A read by chromosome opens only its
folders, one by level skips row groups by their statistics, one by id skips those
whose Bloom filter says no.  A chromosome of most rows is cut over many tasks.

A row without a chromosome, or with an empty one, is stored and read like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocframe import labels as L
from assocframe.roles import Roles, col, resolve_roles, roles_of
from assocframe.sources.load import significant

FOLDER = "_chr"  # the chromosome as text once more; a folder name cannot tell a missing one from an empty one


def store_significant(df: DataFrame, path: str, level: float = L.GENOME_WIDE, roles: Roles | None = None, mode: str = "error") -> None:
    """Write the rows of ``df`` with ``p < level``; all columns stay."""
    r = roles_of(df, roles)
    for role in ("pval", "chr"):
        r.need(role)
    if FOLDER in df.columns:
        raise ValueError(f"a column named {FOLDER} would be taken for the folder")
    placed = significant(df, level, r).withColumn(FOLDER, F.nullif(col(r.chr).cast("string"), F.lit("")))
    order = [col(FOLDER), col(r.pval)]
    writer = placed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(FOLDER)
    if r.snp is not None:
        # Filters grow to fit the ids of their row group.
        writer = writer.option(f"parquet.bloom.filter.enabled#{r.snp}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)


def read_significant(
    spark: SparkSession,
    path: str,
    chromosomes: Sequence[str] | None = None,
    level: float | None = None,
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """The stored rows, all or of ``chromosomes``, below ``level`` and with one of ``ids``.

    Spark asks Bloom filters for up to ``spark.sql.parquet.pushdown.inFilterThreshold``
    ids at once, beyond that only the range of ids; join with a table of ids if there are many.
    """
    written = spark.read.parquet(path).schema
    # Folder names are text, even where all of them look like numbers.
    fields = [T.StructField(FOLDER, T.StringType()) if f.name == FOLDER else f for f in written.fields]
    rows = spark.read.schema(T.StructType(fields)).parquet(path)
    r = resolve_roles([c for c in rows.columns if c != FOLDER])
    if chromosomes is not None:
        folders = col(FOLDER).isin(list(chromosomes))
        rows = rows.filter(folders | col(FOLDER).isNull() if "" in chromosomes else folders)
        rows = rows.filter(col(r.chr).cast("string").isin(list(chromosomes)))
    if level is not None:
        rows = significant(rows, level, r)
    if ids is not None:
        r.need("snp")
        rows = rows.filter(col(r.snp).isin(list(ids)))
    return rows.drop(FOLDER)
