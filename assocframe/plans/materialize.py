"""Cutting lineage and judging the size of a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``.  A session without that
    setting uses a folder below the warehouse, which all executors share too;
    nothing goes to a folder of one machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder; later plans start from those files."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def has_at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def fits(df: DataFrame, rows: int, size: int) -> bool:
    """Whether a table has at most ``rows`` rows and, written out, ``size`` bytes."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    head = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return head[0] <= rows and head[1] <= size
