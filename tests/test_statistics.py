import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assocframe.operators import correlation as C
from assocframe.operators import quantiles as Q
from assocframe.operators.inflation import lambda_gc, qq_points
from assocframe.plans.quantile import long_values, order_statistics

QS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def samples(kind):
    rng = np.random.default_rng(7)
    if kind == "tail":
        return np.concatenate([rng.random(4000) ** 12, [1e300, -1e300, 5e-324]])
    if kind == "ties":
        return np.concatenate([np.repeat(1.0, 2000), rng.integers(0, 5, 1500).astype(float)])
    if kind == "constant":
        return np.repeat(3.0, 50)
    return rng.normal(size=int(kind))


@pytest.mark.parametrize("kind", ["tail", "ties", "constant", "1", "2", "10", "5001"])
def test_bracket_quantiles_are_exact(spark, kind):
    x = samples(kind)
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(5)
    got = {r.q: r.value for r in Q.exact_quantiles(df, ["x"], QS).collect()}
    for q in QS:
        assert got[q] == pytest.approx(float(np.quantile(x, q)), rel=1e-9, abs=1e-12), q


def test_bracket_quantiles_by_group_and_column(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 3000, p=[0.9, 0.1]), "x": rng.exponential(size=3000), "y": rng.integers(0, 3, 3000).astype(float)})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(pdf)
    got = Q.exact_quantiles(df, ["x", "y"], [0.25, 0.75], ["g"]).collect()
    assert len(got) == 8
    for r in got:
        assert r.value == pytest.approx(pdf[pdf.g == r.g][r.column].quantile(r.q), rel=1e-9)


@pytest.mark.parametrize("size,margin,fine", [(2048, 0.005, 1024), (8, 0.0, 3), (8, 0.2, 1), (64, 0.0, 16)])
def test_order_statistics_survive_useless_brackets(spark, monkeypatch, size, margin, fine):
    """Sketches and margins too small: positions outside their brackets are found all the same."""
    import assocframe.plans.quantile as P

    monkeypatch.setattr(P, "_SKETCH_SIZE", size)
    monkeypatch.setattr(P, "_MARGIN", margin)
    monkeypatch.setattr(P, "_FINE", fine)
    x = np.concatenate([samples("5001"), [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, 1e-300]])
    values = long_values(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"])
    row = order_statistics(values, ["column"], [0.0, 0.5, 1.0], True)[0].first()
    middle = np.sort(x)[[2503, 2504]]
    assert [row["at"][2503], row["at"][2504]] == middle.tolist()
    assert (row["n"], row["min"], row["max"]) == (5008, -1e308, 1e308)


def test_quantiles_take_two_scans(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame(pd.DataFrame({"x": samples("5001")})).repartition(1).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    counted = spark.read.parquet(path).mapInArrow(counting, "x double")
    assert len(Q.exact_quantiles(counted, ["x"], QS).collect()) == len(QS)
    assert read.value == 2 * 5001


def test_quantiles_of_null_groups(spark):
    df = spark.createDataFrame([(None, float(i)) for i in range(5)] + [("a", 1.0)], "g string, x double")
    got = {(r.g, r.q): r.value for r in Q.exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {(None, 0.5): 2.0, ("a", 0.5): 1.0}


def test_outliers_rules(spark):
    rows = [(float(i), 1.0, None, float(i) if i < 9 else None) for i in range(20)] + [(1000.0, 1.0, None, None)]
    df = spark.createDataFrame(rows, "x double, const double, empty double, nine double")
    out = {r.column: r for r in Q.iqr_outliers(df, ["x", "const", "empty", "nine"], drop_zero=False).collect()}
    assert set(out) == {"x", "const"}
    assert out["x"].n_outliers == 1 and out["const"].n_outliers == 0 and out["x"].pct_outliers == 4.76
    assert [r.column for r in Q.iqr_outliers(df, ["x", "const"]).collect()] == ["x"]
    assert [r.x for r in Q.outlier_rows(df, "x").collect()] == [1000.0]


def test_sampled_outliers_use_nearest_rank_and_full_count(spark):
    x = list(range(100)) + [10_000] * 3
    df = spark.createDataFrame([(float(i), k) for k, i in enumerate(x)], "x double, k int")
    row = Q.sampled_iqr_outliers(df, "x", n=1000, key=["k"]).first()
    s = sorted(x)
    q1, q3 = s[int(0.25 * 102 + 0.5)], s[int(0.75 * 102 + 0.5)]
    assert (row.low, row.high, row.n_outliers) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1), 3)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(None,)], "x double")
    bins = {r.bin: r.n for r in Q.histogram(df, ["x"], 10).collect()}
    assert bins == {**{i: 1 for i in range(9)}, 9: 2}
    one = Q.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), ["x"], 5).collect()
    assert [(r.bin, r.n) for r in one] == [(0, 2)]


def test_density_curve_against_summed_kernels(spark):
    rng = np.random.default_rng(8)
    groups = {"a": rng.normal(size=900), None: np.concatenate([rng.normal(size=300), rng.normal(9, 2, 100)]), "one": np.array([4.0]), "flat": np.ones(5)}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None)]
    got = Q.density_curve(spark.createDataFrame(rows, "g string, x double").repartition(3), "x", ["g"], points=60, bins=2000).collect()
    assert {r.g for r in got} == {"a", None} and len(got) == 120
    for g in ("a", None):
        xs, curve = groups[g], sorted((r.x, r.density) for r in got if r.g == g)
        h = xs.std(ddof=1) * len(xs) ** -0.2
        assert curve[0][0] == pytest.approx(xs.min() - 2 * h) and curve[-1][0] == pytest.approx(xs.max() + 2 * h)
        want = [np.exp(-0.5 * ((x - xs) / h) ** 2).sum() / (len(xs) * h * np.sqrt(2 * np.pi)) for x, _ in curve]
        assert [d for _, d in curve] == pytest.approx(want, abs=1e-4)


def test_named_pairs_only(spark):
    df = spark.createDataFrame(corr_frame()).replace(float("nan"), None)
    for method in ("pearson", "spearman", "kendall"):
        every = {(r.col_a, r.col_b): r.r for r in C.correlation(df, list("abcd"), method).collect()}
        some = {(r.col_a, r.col_b): r.r for r in C.correlation(df, list("abcd"), method, [("a", "d"), ("b", "c")]).collect()}
        assert some == {k: pytest.approx(every[k]) for k in (("a", "d"), ("b", "c"))}


def test_box_against_numpy(spark):
    x = np.concatenate([np.random.default_rng(3).normal(size=500), [50.0, -40.0]])
    row = Q.box_stats(spark.createDataFrame(pd.DataFrame({"x": x})), "x").first()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (inside.min(), inside.max(), len(x) - len(inside))


def test_describe_like_pandas(spark):
    pdf = pd.DataFrame({"x": np.random.default_rng(5).normal(size=400)})
    row = Q.describe(spark.createDataFrame(pdf), ["x"]).first()
    want = pdf.x.describe().round(4)
    assert [row["mean"], row["std"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]] == pytest.approx(list(want)[1:])


def corr_frame(n=400, seed=11):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, n).astype(float)
    pdf = pd.DataFrame({"a": x, "b": x + rng.normal(size=n) * 4, "c": rng.integers(0, 3, n).astype(float), "d": rng.permutation(n).astype(float)})
    pdf.loc[::29, "b"] = np.nan
    pdf.loc[3::31, "c"] = np.nan
    return pdf


def tau_b(x, y):
    dx, dy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    return (dx * dy).sum() / np.sqrt((dx * dx).sum() * (dy * dy).sum())


def reference_r(pdf, method, a, b):
    """Pearson of values or of average ranks, Kendall by comparing all rows."""
    full = pdf.dropna()
    if method == "kendall":
        return tau_b(full[a].to_numpy(), full[b].to_numpy())
    full = full.rank() if method == "spearman" else full
    return np.corrcoef(full[a], full[b])[0, 1]


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlation_with_ties_and_nulls(spark, method):
    pdf = corr_frame()
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = C.correlation(df, ["a", "b", "c", "d"], method).collect()
    assert len(got) == 6
    for r in got:
        assert r.r == pytest.approx(reference_r(pdf, method, r.col_a, r.col_b), abs=1e-10)


@pytest.mark.parametrize("method", ["spearman", "kendall"])
@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_rank_correlation_over_many_tasks_and_ranges(spark, monkeypatch, method, ranges):
    """Runs of equal values go over several tasks, and frequent values fill ranges of their own."""
    monkeypatch.setattr(C, "_LEAST_RANGES", ranges)
    monkeypatch.setattr(C, "_MOST_RANGES", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    pdf = corr_frame(300, 5)
    pdf.loc[:150, "a"] = 4.0
    df = spark.createDataFrame(pdf)
    try:
        for r in C.correlation(df, ["a", "b", "d"], method).collect():
            assert r.r == pytest.approx(reference_r(pdf[["a", "b", "d"]], method, r.col_a, r.col_b), abs=1e-10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (50, 3), (400, 400), (700, 20)])
def test_agreement_by_merging(n, top):
    rng = np.random.default_rng(n)
    x, y, g = rng.integers(0, top, n), rng.integers(0, 2 * top, n), rng.integers(0, 4, n)
    want = sum(int((np.sign(x[g == k][:, None] - x[g == k]) * np.sign(y[g == k][:, None] - y[g == k])).sum()) // 2 for k in range(4))
    assert C.agreement(x.astype(float), y.astype(float), g) == want


def test_wide_pearson_in_one_scan(spark, tmp_path, monkeypatch):
    import assocframe.plans.moments as M

    monkeypatch.setattr(M, "_BLOCK", 7)
    rng = np.random.default_rng(2)
    names = [f"c.{i}" for i in range(20)]
    pdf = pd.DataFrame(rng.normal(size=(300, 20)) + 1e6, columns=names)
    pdf["c.3"] = 5.0
    spark.createDataFrame(pdf).repartition(5).write.parquet(str(tmp_path / "wide"))
    found = C.correlation(spark.read.parquet(str(tmp_path / "wide")), names)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(pdf.to_numpy().T)
    got = found.collect()
    assert len(got) == 190
    for r in got:
        if "c.3" in (r.col_a, r.col_b):
            assert r.r is None
        else:
            assert r.r == pytest.approx(want[int(r.col_a[2:]), int(r.col_b[2:])], abs=1e-10)
    empty = C.correlation(spark.createDataFrame(pdf).limit(0), names).collect()
    assert len(empty) == 190 and all(r.r is None for r in empty)


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hash")


def test_exchanges_of_ranks_do_not_grow_with_columns(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(200, 9)), columns=list("abcdefghi"))
    df = spark.createDataFrame(pdf)
    few, many = (exchanges(C.correlation(df, list(pdf.columns[:k]), "spearman")) for k in (2, 9))
    assert many <= few


def test_ranks_are_streamed(monkeypatch):
    """Neither a long run nor a long tie is held: rows come out soon after they were read."""
    import pyarrow as pa

    import assocframe.plans.ranks as R

    monkeypatch.setattr(R, "_SLICE", 50)
    rng = random.Random(7)
    for x in ([0.0] * 400 + [1.0] * 400, list(range(800)), sorted(rng.choice([0, 1, 2, 3.5, rng.random()]) for _ in range(800))):
        x = np.array(x, dtype=float)
        cuts = [0, 5, 130, 131, 400, 800]  # tasks
        parts = [x[a:b] for a, b in zip(cuts, cuts[1:])]
        batches = lambda p, n=10: [
            pa.RecordBatch.from_pydict({"part": pa.array([p] * len(v), pa.int32()), "c": pa.array([0] * len(v), pa.int32()), "value": v})
            for v in (parts[p][i : i + n] for i in range(0, len(parts[p]), n))
        ]
        ties = [t for p in range(5) for b in R._measured_ties(iter(batches(p))) for t in b.to_pylist()]
        # The ends of a task, and ties of 50 rows.
        assert len(ties) <= 2 * 5 + 800 // 50
        before, known = np.cumsum([0] + [len(p) for p in parts]), {}
        for t in ties:
            first, rows = known.get(t["value"], (800, 0))
            known[t["value"]] = min(first, before[t["part"]] + t["start"]), rows + t["n"]
        got, waiting = {}, []
        for p in range(5):
            read = [0]

            def feed():
                at = before[p]
                for b in batches(p):
                    v = b.column("value").to_pylist()
                    read[0] += len(v)
                    yield pa.RecordBatch.from_pydict({
                        "id": np.arange(at, at + len(v)), "c": b.column("c"), "value": v, "before": np.full(len(v), before[p]),
                        "first": pa.array([int(known[k][0]) if k in known else None for k in v], pa.int64()),
                        "rows": pa.array([int(known[k][1]) if k in known else None for k in v], pa.int64()),
                    })
                    at += len(v)

            done = 0
            for out in R._rank_runs(feed()):
                done += out.num_rows
                waiting.append(read[0] - done)
                for row in out.to_pylist():
                    got[row["id"]] = (row["r"], row["t"])
        assert max(waiting) < 50
        series = pd.Series(x)
        want = list(zip(series.rank().tolist(), series.groupby(series).transform("size").tolist()))
        assert [got[i] for i in range(800)] == want


def test_ranks_of_long_ties(spark):
    """Ties longer than what a task waits for, and ties over several tasks."""
    df = spark.range(150_000).selectExpr("id % 2 as a", "CAST(id * 7919 % 150001 AS DOUBLE) as b", "CASE WHEN id < 140000 THEN 3 ELSE id END as c")
    ranks = df.toPandas().rank()
    for r in C.correlation(df, ["a", "b", "c"], "spearman").collect():
        assert r.r == pytest.approx(np.corrcoef(ranks[r.col_a], ranks[r.col_b])[0, 1], abs=1e-9)


def test_constant_and_empty_columns_are_left_out(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5, None), (2.0, 3.0, 5, None)], "a double, b double, c int, d double")
    assert C.correlatable_columns(df) == ["a", "b"]
    assert [(r.col_a, r.col_b) for r in C.correlation(df).collect()] == [("a", "b")]
    assert C.correlation(df, ["a"]).count() == 0
    for method in ("pearson", "spearman", "kendall"):
        assert C.correlation(df, ["a", "c"], method).first().r is None


def test_pair_lists(spark):
    pairs = spark.createDataFrame([("a", "b", -0.95), ("a", "c", 0.9), ("b", "c", 0.1)], "col_a string, col_b string, r double")
    assert [r.r for r in C.top_pairs(pairs, 2).collect()] == [-0.95, 0.9]
    assert [r.r for r in C.top_pairs(pairs, 2, signed=True).collect()] == [0.9, 0.1]
    assert C.collinear_pairs(pairs).count() == 2
    assert sorted(r.r for r in C.threshold_correlation(pairs, 0.5).collect()) == [-0.95, 0.0, 0.9]
    assert C.correlation_matrix(pairs, ["a", "b", "c"]).count() == 9


def test_variance_order(spark):
    df = spark.createDataFrame([(1.0, 10, 5.0), (2.0, 90, 5.0)], "a double, b int, c double")
    assert C.top_variance_columns(df, 2) == ["b", "a"]


def test_inflation_of_even_p_values_is_one(spark):
    n = 2001
    df = spark.createDataFrame([((i + 0.5) / n,) for i in range(n)] + [(0.0,), (None,)], "pval double")
    assert lambda_gc(df).first().lambda_gc == pytest.approx(1.0, abs=2e-3)
    assert lambda_gc(df, "p_ratio").first().lambda_gc == pytest.approx(0.5 / 0.4549)
    assert lambda_gc(df).first().n == n


def test_chi2_of_p_values_matches_the_standard_library(spark):
    from statistics import NormalDist

    from assocframe.functions.scalars import chi2_from_p

    p = [1.0, 0.999, 0.5, 0.2, 0.15, 0.1499, 0.01, 1e-5, 1e-10, 2.7e-11, 1e-12, 1e-100, 1e-300]
    df = spark.createDataFrame([(x,) for x in [*p, 0.0, -1.0, 1.5, None]], "p double")
    got = [r.c for r in df.select(chi2_from_p("p").alias("c")).collect()]
    assert got[: len(p)] == pytest.approx([NormalDist().inv_cdf(x / 2) ** 2 for x in p], rel=1e-12, abs=1e-15)
    assert got[len(p) :] == [None] * 4


def test_inflation_averages_the_transformed_middle_values(spark):
    from statistics import NormalDist

    df = spark.createDataFrame([(0.1,), (0.2,), (0.6,), (0.9,)], "pval double")
    chi = [NormalDist().inv_cdf(p / 2) ** 2 for p in (0.2, 0.6)]
    assert lambda_gc(df).first().lambda_gc == pytest.approx(sum(chi) / 2 / 0.4549)


def test_qq_points_pair_by_rank_with_many_copies(spark, monkeypatch):
    import assocframe.plans.ordering as O

    monkeypatch.setattr(O, "_PIECE", 10)
    rng = random.Random(1)
    p = [rng.random() for _ in range(150)] + [1.0] * 75 + [0.0, None]
    df = spark.createDataFrame([(x,) for x in p], "pval double").repartition(4)
    rows = sorted(qq_points(df, n=None).collect(), key=lambda r: r.i)
    clean = sorted(x for x in p if x)
    assert [r.i for r in rows] == list(range(1, len(clean) + 1))
    assert [r.observed for r in rows] == pytest.approx([-np.log10(x) for x in clean])
    assert [r.expected for r in rows] == pytest.approx([-np.log10(i / len(clean)) for i in range(1, len(clean) + 1)])
    some = qq_points(df.withColumn("k", F.monotonically_increasing_id()), n=40, key=["k"]).collect()
    assert len(some) == 40 and max(r.expected for r in some) == pytest.approx(np.log10(40))
