"""One ordered CSV as parts of bounded length, with a manifest that tells how to put them together.

Rows are sorted over all tasks by ranges of the order's columns, so the parts
follow one another and none is larger than asked for.  The manifest lists them
in order with rows and first keys; parts have no header, which the manifest
gives instead, so header and parts, one after the other, are one CSV file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocframe.roles import col

MANIFEST = "_manifest"  # Spark passes over names that begin with an underscore
#: Quotes in a text are doubled; text that is missing is nothing, text that is empty a pair of quotes.
OPTIONS = {"header": "false", "escape": '"', "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_EMPTY = "\x00"


def write_csv_parts(df: DataFrame, path: str, order: Sequence[str], rows: int = 1_000_000) -> DataFrame:
    """Write ``df`` in ``order`` (ascending, NULL first) as parts of at most ``rows`` rows; returns the manifest."""
    if len(df.columns) < 2:
        raise ValueError("a line of one missing value is no line; export at least two columns")
    spark = df.sparkSession
    ordered = df.orderBy(*[col(c).asc_nulls_first() for c in order])
    ordered.write.options(**OPTIONS).option("emptyValue", '""').option("maxRecordsPerFile", rows).csv(path)
    # Rows and keys are those of the files, not of a plan that might run twice.
    keys = F.struct(*[col(c) for c in order])
    found = _read(spark, path, df.schema).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"), F.min(keys).alias("first_key"))
    numbers = [F.regexp_extract("file_name", pattern, 1).cast("long") for pattern in (r"^part-(\d+)", r"-c(\d+)\.csv")]
    # One row per file.
    placed = found.withColumn("part", F.row_number().over(Window.orderBy(*numbers)))
    header = F.array(*[F.lit(c) for c in df.columns])
    placed.select("part", "file_name", "n_rows", F.to_json("first_key").alias("first_key"), header.alias("header")).coalesce(1).write.json(f"{path}/{MANIFEST}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``part, file_name, n_rows, first_key`` (JSON) and ``header``, one row per part."""
    return spark.read.schema("part int, file_name string, n_rows long, first_key string, header array<string>").json(f"{path}/{MANIFEST}")


def read_csv_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows with the number of their part."""
    parts = read_manifest(spark, path).select("file_name", "part")
    return _read(spark, path, schema).join(F.broadcast(parts), "file_name").drop("file_name")  # a row per file


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # Read as a mark of its own, as Spark takes an empty text for a missing one.
    rows = spark.read.options(**OPTIONS).option("emptyValue", _EMPTY).schema(schema).csv(path)
    texts = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    columns = [F.when(col(c) == _EMPTY, "").otherwise(col(c)).alias(c) if c in texts else col(c) for c in schema.names]
    return rows.select(*columns, F.col("_metadata.file_name").alias("file_name"))
