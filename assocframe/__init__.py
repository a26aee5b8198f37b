"""Variant-association analytics as Spark DataFrame operators."""

from assocframe.operators.annotate import annotate, with_traits, with_variant_facts
from assocframe.operators.correlation import correlation, correlation_matrix, top_pairs
from assocframe.operators.filters import association_filter, chr_filter, level_filter, typed_filter
from assocframe.operators.inflation import lambda_gc, qq_points
from assocframe.operators.loci import cluster_loci, loci_summary, presence_matrix
from assocframe.operators.manhattan import manhattan_points
from assocframe.operators.overlap import overlap_counts, overlap_loci, pair_counts, pair_loci
from assocframe.operators.profile import column_profile, quality_kpis
from assocframe.operators.quantiles import box_stats, describe, exact_quantiles, histogram, iqr_outliers
from assocframe.operators.sampling import sample_exact, sample_per_group, sample_proportional
from assocframe.operators.summary import (
    chr_distribution,
    dataset_summary,
    derived_metrics,
    tier_counts,
    top_associations,
)
from assocframe.roles import Roles, canonicalize, resolve_roles
from assocframe.sources.csv_parts import read_csv_parts, write_csv_parts
from assocframe.sources.load import load, load_plot_columns, scan, write_csv
from assocframe.sources.stored import read_significant, store_significant

__all__ = [
    "Roles",
    "annotate",
    "association_filter",
    "box_stats",
    "canonicalize",
    "chr_distribution",
    "chr_filter",
    "cluster_loci",
    "column_profile",
    "correlation",
    "correlation_matrix",
    "dataset_summary",
    "derived_metrics",
    "describe",
    "exact_quantiles",
    "histogram",
    "iqr_outliers",
    "lambda_gc",
    "level_filter",
    "load",
    "load_plot_columns",
    "loci_summary",
    "manhattan_points",
    "overlap_counts",
    "overlap_loci",
    "pair_counts",
    "pair_loci",
    "presence_matrix",
    "qq_points",
    "quality_kpis",
    "resolve_roles",
    "sample_exact",
    "sample_per_group",
    "sample_proportional",
    "scan",
    "tier_counts",
    "top_associations",
    "top_pairs",
    "typed_filter",
    "with_traits",
    "with_variant_facts",
    "read_csv_parts",
    "read_significant",
    "store_significant",
    "write_csv",
    "write_csv_parts",
]
