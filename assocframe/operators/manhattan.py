"""The data feed of a Manhattan plot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.functions.scalars import chr_order, neg_log10_floor
from assocframe.operators.filters import chr_filter, clean_pvalues, logp_filter
from assocframe.operators.sampling import sample_exact, sample_key
from assocframe.plans.ordering import global_row_number
from assocframe.roles import Roles, col, roles_of


def manhattan_points(
    df: DataFrame,
    chroms: Sequence[str] | None = None,
    min_logp: float = 0.0,
    cap: int | None = None,
    seed: int = 42,
    roles: Roles | None = None,
) -> DataFrame:
    """``x, y, chr, snp``: place along the genome and -log10(p) of the chosen variants.

    With ``cap`` at most that many points are drawn (after the filters);
    without it every variant is numbered by a distributed sort.
    """
    r = roles_of(df, roles)
    r.need("pval", "chr", "snp")
    view = logp_filter(chr_filter(clean_pvalues(df, r), chroms, r), min_logp, r)
    if cap is not None:
        view = sample_exact(view, cap, sample_key(df, r), seed)
    points = view.select(
        neg_log10_floor(col(r.pval)).alias("y"),
        col(r.chr).cast("string").alias("chr"),
        col(r.snp).cast("string").alias("snp"),
        (col(r.pos) if r.pos is not None else F.lit(0)).alias("_pos"),
        col(r.pval).alias("_p"),
    )
    order = [*chr_order(col("chr")), col("_pos").asc_nulls_last(), col("snp").asc_nulls_last(), col("_p").asc()]
    numbered = global_row_number(points, order, "x", start=0)
    return numbered.select("x", "y", "chr", "snp")
