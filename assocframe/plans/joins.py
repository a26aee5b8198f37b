"""Joins of a table with a table of one row per key.

Spark's adaptive execution sees sizes at run time: it broadcasts a side that
proves small and splits the partitions of frequent keys
(``spark.sql.adaptive.skewJoin.enabled``, on by default).  What it does not do is
told here: which sides are known to be small beforehand, so that the large one is
not shuffled at all; that NULL is a group like any other; and that NULL ids need
not meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.plans.materialize import fits
from assocframe.roles import col

_SPREAD = 4096
_FEW_ROWS, _FEW_BYTES = 100_000, 32 << 20


def few_groups(stored: DataFrame) -> bool:
    """Whether a table that is written already is small enough to be broadcast, by rows and bytes."""
    return fits(stored, _FEW_ROWS, _FEW_BYTES)


def group_join(big: DataFrame, small: DataFrame, keys: Sequence[str], bounded: bool = False) -> DataFrame:
    """Inner join with figures of groups, one row per key in ``small``; NULL keys are equal.

    ``bounded`` states that the caller can prove a bound on ``small`` (for
    example one row per column name), which is then broadcast.
    """
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    other = small.select(*[col(c).alias(names.get(c, c)) for c in small.columns])
    match = F.lit(True)
    for k, name in names.items():
        match = match & col(k).eqNullSafe(col(name))
    return big.join(F.broadcast(other) if bounded else other, match).drop(*names.values())


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Left or inner join with one row per key; NULL matches nothing, so rows with a NULL key are spread over all tasks."""
    keys = list(keys)
    if how == "inner":
        return big.join(small, keys)
    apart = F.lit(False)
    for k in keys:
        apart = apart | col(k).isNull()
    spread = F.lit(1) + F.pmod(F.xxhash64(*[col(c) for c in big.columns]), F.lit(_SPREAD)).cast("int")
    salted = big.withColumn("_salt", F.when(apart, spread).otherwise(F.lit(0)))
    return salted.join(small.withColumn("_salt", F.lit(0)), [*keys, "_salt"], how).drop("_salt")
