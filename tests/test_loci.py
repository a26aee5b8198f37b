import math
import random

import pytest

from assocframe.operators.loci import cluster_loci, loci_summary, presence_matrix
from assocframe.operators.overlap import overlap_counts, overlap_loci, pair_counts, pair_loci

SCHEMA = "disorder string, chr string, pos long, pval double, variant_id string"


def brute_loci(rows, window):
    """(disorder, chr, start, end, n, lead id) by walking positions in order."""
    groups = {}
    for d, c, pos, p, i in rows:
        if None not in (c, pos, p) and p < 5e-8:
            groups.setdefault((d, c), []).append((pos, p, i))
    found = []
    for (d, c), members in groups.items():
        members.sort()
        runs = [[members[0]]]
        for m in members[1:]:
            if m[0] - runs[-1][-1][0] > window:
                runs.append([])
            runs[-1].append(m)
        for run in runs:
            lead = min(run, key=lambda m: (m[1], m[0], m[2]))
            found.append((d, c, run[0][0], run[-1][0], len(run), lead[2]))
    return sorted(found)


def as_tuples(loci):
    return sorted((r.disorder, r.chr, r.start, r.end, r.n_snps, r.lead_snp) for r in loci.collect())


@pytest.mark.parametrize("window_kb", [0, 1, 250, 1000])
def test_against_brute_force(spark, window_kb):
    rng = random.Random(window_kb)
    rows = [
        (rng.choice("ab"), rng.choice(["1", "2", "X", None]), rng.randrange(-300_000, 20_000_000, 500),
         rng.choice([1e-9, 2e-9, 1e-3, None]), f"rs{i}")
        for i in range(3000)
    ]
    rows += [("a", "1", 5_000_000, 1e-9, f"hot{i}") for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert as_tuples(cluster_loci(df, window_kb=window_kb)) == brute_loci(rows, window_kb * 1000)


def test_gap_edges(spark):
    rows = [("d", "1", p, 1e-9, f"rs{p}") for p in (1_000_000, 1_249_999, 1_499_999, 1_750_000)]
    rows += [("d", "2", 5, 5e-8, "level"), ("d", "3", 7, 1e-8, "single"), ("d", "4", 7, math.nan, "nan")]
    loci = {r.locus_id: r for r in cluster_loci(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(r.chr, r.start, r.end, r.n_snps) for r in loci.values()] == [
        ("1", 1_000_000, 1_499_999, 3), ("1", 1_750_000, 1_750_000, 1), ("3", 7, 7, 1),
    ]
    assert loci["L1"].width_kb == 500.0 and loci["L3"].interpretation == "—"


def test_lead_ties_and_zero_p(spark):
    rows = [("d", "1", 200, 0.0, "b"), ("d", "1", 100, 0.0, "a"), ("d", "2", 5, 1e-9, "y"), ("d", "2", 5, 1e-9, "x")]
    loci = cluster_loci(spark.createDataFrame(rows, SCHEMA)).orderBy("chr").collect()
    assert [(r.lead_snp, r.lead_pos) for r in loci] == [("a", 100), ("x", 5)]
    assert loci[0].lead_logp == math.inf and loci[1].lead_logp == 9.0


def test_text_positions_and_missing_roles(spark):
    df = spark.createDataFrame([("1", "12", "1e-9"), ("1", "x", "1e-9"), ("1", None, "1e-9"), ("1", "40", "y")], "chr string, bp string, p string")
    assert [(r.start, r.end, r.n_snps) for r in cluster_loci(df).collect()] == [(12, 12, 1)]
    empty = cluster_loci(spark.createDataFrame([("d", 0.1)], "disorder string, pval double"))
    assert empty.count() == 0 and empty.columns[:3] == ["disorder", "locus_id", "chr"]


def test_odds_ratio_of_lead(spark):
    df = spark.createDataFrame(
        [("1", 1, 1e-9, 0.1, "LOG_OR"), ("2", 1, 1e-9, 1.2, "or"), ("3", 1, 1e-9, 1.2, None)],
        "chr string, pos long, pval double, beta double, effect_kind string",
    )
    assert [r.lead_or for r in cluster_loci(df).orderBy("chr").collect()] == [1.105, 1.2, 1.2]
    direct = spark.createDataFrame([("1", 1, 1e-9, 0.8)], "chr string, pos long, pval double, odds_ratio double")
    row = cluster_loci(direct).first()
    assert row.lead_or == 0.8 and row.lead_effect is None and row.interpretation == "↓ riesgo ~20% (protector)"


def test_properties(spark, v):
    sizes = []
    for window in (50, 250, 1000):
        loci = cluster_loci(v, window_kb=window).collect()
        sizes.append(len(loci))
        assert sum(r.n_snps for r in loci) == v.filter("pval < 5e-8 AND chr IS NOT NULL").count()
        by_chr = {}
        for r in loci:
            by_chr.setdefault((r.disorder, r.chr), []).append((r.start, r.end))
        for spans in by_chr.values():
            spans.sort()
            assert all(b[0] - a[1] > window * 1000 for a, b in zip(spans, spans[1:]))
    assert sizes == sorted(sizes, reverse=True)


INTERVALS = [
    ("a", "L1", "1", 100_000, 200_000), ("b", "L1", "1", 200_000, 300_000), ("b", "L2", "1", 350_000, 360_000),
    ("b", "L3", "1", 350_001, 360_000), ("c", "L1", "1", 120_000, 130_000), ("c", "L2", "2", 100_000, 200_000),
    ("a", "L2", "2", 500_000, 90_500_000), ("c", "L3", "2", 80_000_000, 80_000_001),
]


def intervals(spark):
    return spark.createDataFrame(INTERVALS, "disorder string, locus_id string, chr string, start long, end long")


def brute_pairs(margin):
    return sorted(
        (a[0], b[0], a[1], b[1], a[2], a[3] - margin <= b[4] and b[3] - margin <= a[4])
        for a in INTERVALS for b in INTERVALS if a[0] < b[0] and a[2] == b[2]
    )


@pytest.mark.parametrize("margin_kb", [0, 150, 0.001])
def test_overlap_against_brute_force(spark, margin_kb):
    loci = intervals(spark)
    expected = brute_pairs(int(margin_kb * 1000))
    listed = pair_loci(loci, margin_kb)
    key = lambda r: (r.disorder_a, r.disorder_b, r.locus_a, r.locus_b, r.chr)
    assert sorted((*key(r), r.overlaps) for r in listed.collect()) == expected
    hits = overlap_loci(loci, margin_kb, bin_bp=100_000)
    assert sorted(key(r) for r in hits.collect()) == [e[:5] for e in expected if e[5]]
    counts = {(r.disorder_a, r.disorder_b): (r.n_pairs, r.n_overlaps) for r in pair_counts(loci, margin_kb).collect()}
    for pair, (n, hit) in counts.items():
        rows = [e for e in expected if (e[0], e[1]) == pair]
        assert (n, hit) == (len(rows), sum(e[5] for e in rows))


def test_join_equals_filtered_pairs(v):
    loci = cluster_loci(v).cache()
    for margin in (0, 250, 500):
        listed = pair_loci(loci, margin).filter("overlaps").drop("overlaps")
        joined = overlap_loci(loci, margin)
        assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, joined.collect()))


def test_summary_and_matrix_keep_disorders_without_loci(spark):
    rows = [("d", "10", 5, 1e-9, "x"), ("d", "2", 5, 1e-9, "y"), ("d", "X", 5, 1e-9, "z"), ("e", "1", 5, 0.5, "w")]
    df = spark.createDataFrame(rows, SCHEMA)
    loci = cluster_loci(df)
    summary = {r.disorder: (r.n_loci, r.n_snps, r.largest_locus) for r in loci_summary(loci, df.select("disorder").distinct()).collect()}
    assert summary == {"d": (3, 3, 1), "e": (0, 0, 0)}
    assert [tuple(r) for r in presence_matrix(loci, ["d", "e"]).collect()] == [("2", "✓", ""), ("10", "✓", ""), ("X", "✓", "")]
    assert overlap_counts(overlap_loci(loci)).count() == 0
