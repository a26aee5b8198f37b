"""Facts about Parquet files: sizes, rows, blocks, headers.  Spark opens and lists all of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AT_ONCE = 16


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file_path, file_name, n_bytes`` of every Parquet file; file contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(_as_list(paths))
    )
    return listing.select(
        F.col("path").alias("file_path"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("n_bytes"),
    )


def file_blocks(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file_path, file_name, n_bytes, block_start, n_rows`` of every part of a file that Spark reads as one.

    Only row counts are read, no column; files of any header may be mixed.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(*_as_list(paths))
    facts = ("file_path", "file_name", "file_size", "file_block_start")
    named = rows.select(*[F.col(f"_metadata.{f}").alias(f) for f in facts])
    counted = named.groupBy(*facts).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        "file_path", "file_name", F.col("file_size").alias("n_bytes"), F.col("file_block_start").alias("block_start"), "n_rows"
    )


def _plain_path() -> Column:
    """A file's path; listings and scans write different numbers of slashes after the scheme."""
    return F.regexp_replace("file_path", "^([A-Za-z0-9+.-]+):/+", "$1:/")


def file_sizes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Size in MB and row count per file; a file without rows counts 0."""
    rows = file_blocks(spark, paths).groupBy(_plain_path().alias("_path")).agg(F.sum("n_rows").alias("n_rows"))
    return (
        list_files(spark, paths)
        .withColumn("_path", _plain_path())
        .join(rows, "_path", "left")
        .select("file_name", "n_bytes", (F.col("n_bytes") / 1024**2).alias("mb"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    )


def file_totals(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file_name, n_rows, n_columns`` per file."""
    found = None
    for schema, files in headers(spark, paths):
        part = file_sizes(spark, files).select("file_name", "n_rows", F.lit(len(schema.fields)).alias("n_columns"))
        found = part if found is None else found.unionByName(part)
    return found


def headers(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """``(schema, paths)`` per distinct header: the names and types of its columns.

    Footers of many files are read by one Spark job; the driver then asks Spark
    for one schema per distinct header, not per file.  Files of one header
    keep the paths given.  Only names and marks of headers reach the driver;
    Spark's own file index holds the names too.
    """
    listing = list_files(spark, paths).select("file_path")
    files = sorted(r["file_path"] for r in listing.toLocalIterator())
    alike: dict[str, list[str]] = {}
    if len(files) > _AT_ONCE:
        for r in listing.mapInArrow(_with_marks, "file_path string, mark string").toLocalIterator():
            alike.setdefault(r["mark"] or r["file_path"], []).append(r["file_path"])
    else:
        alike = {f: [f] for f in files}
    same_header = sorted(sorted(group) for group in alike.values())
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        schemas = list(pool.map(lambda group: spark.read.parquet(group[0]).schema, same_header))
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, group in zip(schemas, same_header, strict=True):
        same = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        found.setdefault(same, (schema, []))[1].extend(group)
    if len(found) == 1:
        return [(schemas[0], _as_list(paths))]
    return [(schema, sorted(group)) for schema, group in found.values()]


def _with_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = [header_mark(path) for path in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["file_path", "mark"])


def header_mark(path: str) -> str | None:
    """A digest of all in a footer that decides Spark's schema; None where Arrow knows no such file system."""
    local = "/" + path[5:].lstrip("/") if path.startswith("file:") else path
    try:
        where, inner = fs.FileSystem.from_uri(path) if "://" in local else (fs.LocalFileSystem(), local)
    except (pa.ArrowException, OSError):
        return None
    with where.open_input_file(inner) as source:
        footer = pq.read_metadata(source)
    columns = str(footer.schema).split("\n", 1)[1]  # after the line that names a Python object
    by_spark = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return hashlib.sha256(columns.encode("utf-8", "surrogatepass") + by_spark).hexdigest()
