"""A blocked Bloom filter of ids, so that rows of a large table that cannot match skip the shuffle of a join.

An id falls into one block of 32,768 bits and sets a few bits there.  The blocks
are bitmaps that Spark merges map-side; the whole filter is at most
``MAX_BLOCKS * 4`` KB, whatever the table of ids holds, and is broadcast.  With
too many ids for that it says "maybe" more often, which costs time and changes
no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe.plans.materialize import plan_bytes
from assocframe.roles import col

MIN_BLOCKS, MAX_BLOCKS = 64, 8192
BITS = 32_768
PROBES = 3
_BITS_PER_ID, _BYTES_PER_ID = 16, 32


def blocks_for(ids: DataFrame) -> int:
    """A number of blocks that gives each id some 16 bits, by Catalyst's size estimate."""
    wanted = plan_bytes(ids) // _BYTES_PER_ID * _BITS_PER_ID // BITS
    return max(MIN_BLOCKS, min(MAX_BLOCKS, wanted))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _places(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(BITS)) for probe in range(PROBES)]


def id_filter(ids: DataFrame, column: str, blocks: int) -> DataFrame:
    """``_block, _bits``: at most one row of 4 KB per block; NULL ids are left out."""
    key = col(column)
    found = ids.filter(key.isNotNull()).select(_block(key, blocks).alias("_block"), F.explode(F.array(*_places(key))).alias("_place"))
    return found.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits"))


def could_match(df: DataFrame, column: str, ids: DataFrame, id_column: str, blocks: int | None = None) -> DataFrame:
    """``df`` with ``_maybe``: false only if the value of ``column`` is no id; no exchange of ``df``."""
    blocks = blocks_for(ids) if blocks is None else blocks
    known = F.broadcast(id_filter(ids, id_column, blocks))
    joined = df.withColumn("_block", _block(col(column), blocks)).join(known, "_block", "left")
    maybe = col(column).isNotNull() & F.col("_bits").isNotNull()
    for place in _places(col(column)):
        byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        maybe = maybe & (F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1)
    return joined.withColumn("_maybe", F.coalesce(maybe, F.lit(False))).drop("_block", "_bits")
