"""Comparing the loci of different disorders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.functions.scalars import region_label
from assocframe.roles import col

BIN_BP = 1_000_000
_LOCI_A_PART = 512


def _side(loci: DataFrame, side: str) -> DataFrame:
    return loci.select(
        col("chr"),
        col("disorder").alias(f"disorder_{side}"),
        col("locus_id").alias(f"locus_{side}"),
        col("start").alias(f"start_{side}"),
        col("end").alias(f"end_{side}"),
    )


def _overlaps(margin: int) -> Column:
    """Closed ends; loci nearer than the margin count as overlapping."""
    return (col("start_a") - margin <= col("end_b")) & (col("start_b") - margin <= col("end_a"))


def _labelled(pairs: DataFrame, *more: Column) -> DataFrame:
    return pairs.select(
        "disorder_a",
        "disorder_b",
        "locus_a",
        "locus_b",
        "chr",
        region_label(col("start_a"), col("end_a")).alias("region_a"),
        region_label(col("start_b"), col("end_b")).alias("region_b"),
        *more,
    )


def pair_loci(loci: DataFrame, margin_kb: float = L.OVERLAP_MARGIN_KB) -> DataFrame:
    """Every pair of loci of two disorders on one chromosome, with an overlap flag.

    The table lists non-overlapping pairs too, so its size is the product of
    the two loci counts; ``overlap_loci`` gives only the overlapping pairs and
    ``pair_counts`` only the numbers.  Loci of one disorder are disjoint, which
    bounds each side by chromosome length / window.  One side is split into
    parts of about _LOCI_A_PART loci, so that a chromosome is not one task.
    """
    margin = int(margin_kb * 1000)
    parts = loci.groupBy("chr").agg(F.ceil(F.count(F.lit(1)) / _LOCI_A_PART).alias("parts"))
    a = _side(loci, "a").join(parts, "chr").withColumn("part", F.pmod(F.xxhash64("start_a", "disorder_a"), "parts")).drop("parts")
    b = _side(loci, "b").join(parts, "chr").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), col("parts") - 1))).drop("parts")
    pairs = a.join(b, ["chr", "part"]).filter(col("disorder_a") < col("disorder_b"))
    return _labelled(pairs, _overlaps(margin).alias("overlaps"))


def overlap_loci(loci: DataFrame, margin_kb: float = L.OVERLAP_MARGIN_KB, bin_bp: int = BIN_BP) -> DataFrame:
    """Overlapping pairs only, by an equi-join on chromosome and position bin.

    Side a is widened by the margin on both ends.  A pair sharing several bins
    is reported in the first of them, so no duplicates have to be removed.
    """
    margin = int(margin_kb * 1000)

    def bin_of(position: Column) -> Column:
        return F.floor(position / bin_bp)

    a = _side(loci, "a").withColumn("first_a", bin_of(col("start_a") - margin))
    b = _side(loci, "b").withColumn("first_b", bin_of(col("start_b")))
    a = a.withColumn("bin", F.explode(F.sequence("first_a", bin_of(col("end_a") + margin))))
    b = b.withColumn("bin", F.explode(F.sequence("first_b", bin_of(col("end_b")))))
    pairs = a.join(b, ["chr", "bin"]).filter(
        (col("disorder_a") < col("disorder_b"))
        & _overlaps(margin)
        & (col("bin") == F.greatest("first_a", "first_b"))
    )
    return _labelled(pairs)


def overlapping_pairs(loci: DataFrame, margin_kb: float = L.OVERLAP_MARGIN_KB) -> DataFrame:
    """The rows of ``pair_loci`` that overlap, without listing the others."""
    return overlap_loci(loci, margin_kb).withColumn("overlaps", F.lit(True))


def overlap_counts(overlapping: DataFrame) -> DataFrame:
    """Overlapping loci per pair of disorders."""
    return overlapping.groupBy("disorder_a", "disorder_b").agg(F.count(F.lit(1)).alias("n_overlaps"))


def pair_counts(loci: DataFrame, margin_kb: float = L.OVERLAP_MARGIN_KB) -> DataFrame:
    """Pairs on one chromosome and overlapping pairs per pair of disorders, without listing pairs."""
    per_chr = loci.groupBy("disorder", "chr").agg(F.count(F.lit(1)).alias("n"))
    a = per_chr.select(col("disorder").alias("disorder_a"), "chr", col("n").alias("n_a"))
    b = per_chr.select(col("disorder").alias("disorder_b"), "chr", col("n").alias("n_b"))
    sizes = (
        a.join(b, "chr")
        .filter(col("disorder_a") < col("disorder_b"))
        .groupBy("disorder_a", "disorder_b")
        .agg(F.sum(col("n_a") * col("n_b")).alias("n_pairs"))
    )
    found = overlap_counts(overlap_loci(loci, margin_kb))
    return sizes.join(found, ["disorder_a", "disorder_b"], "left").fillna(0, ["n_overlaps"])
