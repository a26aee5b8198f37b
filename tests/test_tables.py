import random

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.operators import filters as X
from assocframe.operators import profile as P
from assocframe.operators import sampling as S
from assocframe.operators import summary as M
from assocframe.operators.annotate import annotate, with_traits, with_variant_facts
from assocframe.operators.manhattan import manhattan_points
from assocframe.plans.joins import group_join, lookup_join
from assocframe.plans.ordering import global_row_number
from assocframe.roles import MissingRole, col
from assocframe.sources.csv_parts import read_csv_parts, write_csv_parts
from assocframe.sources.files import file_blocks, file_sizes, file_totals, headers
from assocframe.sources.load import load, load_plot_columns, read_many, scan_roles, to_pandas, write_csv


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Plans ----------------------------------------------------------------------------


@pytest.mark.parametrize("copies", [0, 700])
def test_global_row_number_with_ties_and_copies(spark, monkeypatch, copies):
    import assocframe.plans.ordering as O

    monkeypatch.setattr(O, "_PIECE", 64)
    rng = random.Random(copies)
    data = [(rng.randrange(5), i) for i in range(900)] + [(2, -1)] * copies + [(None, 7)]
    df = spark.createDataFrame(data, "a int, b int").repartition(6)
    out = global_row_number(df, [F.col("a").asc_nulls_last(), F.col("b")], "n").collect()
    assert sorted(r.n for r in out) == list(range(1, len(data) + 1))
    ordered = sorted(out, key=lambda r: r.n)
    assert [(r.a, r.b) for r in ordered] == sorted(data, key=lambda t: (t[0] is None, t[0] or 0, t[1]))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_spreads_rows_without_a_key(spark, how):
    big = spark.createDataFrame([(i % 7 if i % 3 else None, i) for i in range(500)], "k int, x int")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(5)] + [(None, "never")], "k int, v string")
    want = rows_of(big.join(small, ["k"], how))
    assert rows_of(lookup_join(big, small, ["k"], how)) == want


@pytest.mark.parametrize("bounded", [True, False])
def test_group_join_takes_null_for_a_group(spark, bounded):
    big = spark.createDataFrame([(None, "a", 1), (1, "a", 2), (1, None, 3), (2, "b", 4)], "k int, g string, x int")
    small = spark.createDataFrame([("a", None, "n"), (None, 1, "m"), ("b", 3, "o")], "g string, k int, v string")
    assert {(r.x, r.v) for r in group_join(big, small, ["k", "g"], bounded).collect()} == {(1, "n"), (3, "m")}


def test_sizes_of_equally_named_files(spark, tmp_path):
    for name, n in (("a", 3), ("b", 5)):
        (tmp_path / name).mkdir()
        pq.write_table(pa.table({"x": list(range(n))}), tmp_path / name / "part.parquet")
    found = file_sizes(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).collect()
    assert sorted(r.n_rows for r in found) == [3, 5]


# Samples --------------------------------------------------------------------------


def test_sample_is_exact_and_independent_of_partitions(v):
    one = rows_of(S.sample_exact(v.repartition(3), 777))
    assert len(one) == 777 and one == rows_of(S.sample_exact(v.repartition(11), 777))
    assert one != rows_of(S.sample_exact(v, 777, seed=43))
    assert S.sample_exact(v, 10**9).count() == v.count()


@pytest.mark.parametrize("digits", [1, 3, 8])
@pytest.mark.parametrize("ranked", [250_000, 50])
def test_samples_do_not_depend_on_cuts_and_buckets(v, monkeypatch, digits, ranked):
    want = rows_of(v.withColumn("_h", S.sample_hash(v.columns)).orderBy("_h").limit(777).drop("_h"))
    monkeypatch.setattr(S, "_DIGITS", digits)
    monkeypatch.setattr(S, "_RANKED", ranked)
    assert rows_of(S.sample_exact(v, 777)) == want


def test_sample_of_copies_and_of_one_key(spark):
    df = spark.createDataFrame([("same", 1)] * 500 + [(f"k{i}", i) for i in range(500)], "k string, x int")
    assert S.sample_exact(df, 300).count() == 300
    # Hashes in clumps: the cut leaves too few rows, or none, below it.
    for key in range(5):
        clump = df.withColumn("g", F.when(col("k") == "same", F.lit(key)).otherwise(F.lit(key + 100)))
        assert S.sample_exact(clump, 20, ["g"]).count() == 20
        assert S.sample_per_group(clump, 7, ["k"], ["g"]).count() == 507
    groups = spark.createDataFrame([(None, i) for i in range(50)] + [("a", i) for i in range(3)], "g string, x int")
    assert {(r.g, r["count"]) for r in S.sample_per_group(groups, 10, ["g"]).groupBy("g").count().collect()} == {(None, 10), ("a", 3)}


def test_samples_scan_twice(spark, tmp_path):
    """Groups are counted, rows below the cut are ranked; the scan that tops groups up is left out at run time."""
    path = str(tmp_path / "x")
    spark.range(30_000).selectExpr("id", "id % 3 as g").write.parquet(path)
    found = S.sample_exact(spark.read.parquet(path), 300, ["id"])
    assert len(found.collect()) == 300
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2


@pytest.mark.parametrize("sample", [lambda df: S.sample_per_group(df, 100, ["g"], ["id"]), lambda df: S.sample_proportional(df, 300, ["g"], ["id"])])
def test_samples_of_few_groups_do_not_shuffle_the_table(spark, tmp_path, sample):
    """Whatever Spark would broadcast itself: only rows near the cut of their group travel, and the table is not sorted."""
    path = str(tmp_path / "x")
    spark.range(30_000).selectExpr("id", "NULLIF(id % 3, 2) as g").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sample(spark.read.parquet(path))
        assert {(r.g, r["count"]) for r in found.groupBy("g").count().collect()} == {(None, 100), (0, 100), (1, 100)}
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == 1 and "SortMergeJoin" not in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_samples_per_group(v):
    got = S.sample_per_group(v, 100, ["disorder", "chr"]).groupBy("disorder", "chr").count().collect()
    assert len(got) == 18 and all(r["count"] == 100 for r in got)
    total = v.count()
    want = {(r.disorder, r.chr): max(1, int(r["count"] * (600 / total))) for r in v.groupBy("disorder", "chr").count().collect()}
    got = S.sample_proportional(v, 600, ["disorder", "chr"]).groupBy("disorder", "chr").count().collect()
    assert {(r.disorder, r.chr): r["count"] for r in got} == want
    assert S.sample_proportional(v, total, ["chr"]).count() == total


def test_imputed_values_are_flagged_and_in_range(v):
    out = S.impute_uniform(v, "maf", ["variant_id", "pos"])
    rows = out.filter("is_imputed").collect()
    assert rows and all(0.01 <= r.maf <= 0.5 for r in rows)
    assert len({r.maf for r in rows}) > len(rows) / 2
    assert out.filter("NOT is_imputed").count() == v.filter("maf IS NOT NULL").count()


def test_pval_maf_points(spark):
    df = spark.createDataFrame([(1, "0.5", 0.1), (2, "bad", 0.2), (3, None, None), (4, "0.3", None)], "k int, PALVALUE string, MAF double")
    assert rows_of(S.pval_maf_points(df)) == [(0.1, 0.5), (0.2, 1.0)]
    filled = S.pval_maf_points(df, impute=True).collect()
    assert len(filled) == 4 and sum(r.is_imputed for r in filled) == 2
    with pytest.raises(MissingRole):
        S.pval_maf_points(df.drop("MAF"))


# Filters --------------------------------------------------------------------------


def test_filter_rules(spark):
    df = spark.createDataFrame([(1, "Alpha"), (5, "beta+"), (9, None), (None, "ALPHABET")], "x int, t string")
    assert X.range_filter(df, "x", 1, 5).count() == 2 and X.range_filter(df, "x").count() == 3
    assert X.category_filter(df, "t").count() == 3 and X.category_filter(df, "t", ["Alpha"]).count() == 1
    assert X.text_filter(df, "t", "alpha").count() == 2 and X.text_filter(df, "t", "none").count() == 0
    assert X.text_filter(df, "t", "beta+", literal=True).count() == 1 and X.text_filter(df, "t", "").count() == 4
    assert X.drop_incomplete(df).count() == 2


def test_filter_kind_follows_type_and_distinct_values(spark):
    df = spark.range(200).select(
        F.col("id").alias("n"), (F.col("id") % 39).cast("string").alias("few"),
        (F.col("id") % 40).cast("string").alias("more"), F.col("id").cast("string").alias("many"),
    )
    assert [X.filter_kind(df, c) for c in df.columns] == ["range", "category", "text", "text"]
    assert X.typed_filter(df, "few", values=["1"]).count() == 6
    assert X.typed_filter(df, "many", text="^19.$").count() == 10
    assert X.typed_filter(df, "n", 5, 6).count() == 2
    assert X.typed_filter(df, "few", text="^3.$").count() == 45  # the argument decides, whatever the number of values
    assert X.typed_filter(df, "many", values=["7", "8"]).count() == 2 and X.typed_filter(df, "few").count() == 200
    for wrong in ({"text": "x", "values": ["x"]}, {"low": 1}):
        with pytest.raises(ValueError):
            X.typed_filter(df, "few", **wrong)
    with pytest.raises(ValueError):
        X.typed_filter(df, "n", text="1")


def test_nothing_is_left_out_unless_asked_for(spark):
    """Points, patterns and numbered rows cover tables larger than any limit of a plot."""
    n = 21_000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") / n + 1e-9).alias("pval"), (F.col("id") % 7 / 20).alias("maf"))
    from assocframe.operators.inflation import qq_points

    assert qq_points(df).count() == n
    assert S.scatter_points(df, ["maf", "pval"]).count() == n and S.pval_maf_points(df).count() == n
    assert X.rows_indexed(df, ["k"], "pval").agg(F.count("*"), F.max("index"), F.min("index")).first()[:] == (n, n - 1, 0)
    assert P.null_patterns(df.withColumn("x", F.when(F.col("k") > 5, 1))).agg(F.sum("n_rows")).first()[0] == n
    for call in (lambda: X.first_rows(df, ["k"]), lambda: S.pvalue_sample_per_disorder(df)):
        with pytest.raises(TypeError):
            call()


def test_level_and_chromosome(v):
    assert X.level_filter(v, 1.0).count() == v.count()
    assert X.chr_filter(v, []).count() == v.count()
    assert X.chr_filter(v, ["1", "X"]).select("chr").distinct().count() == 2


def test_fill_constants(spark):
    df = spark.createDataFrame([(None, 1.0), (0.2, None)], "pval double, maf double")
    assert rows_of(X.fill_constants(df, {"pval": 1.0})) == rows_of(spark.createDataFrame([(1.0, 1.0), (0.2, None)], df.schema))


# Summaries ------------------------------------------------------------------------


def test_metrics_on_edges(spark):
    schema = "disorder string, chr string, pos long, snp string, pval double"
    df = spark.createDataFrame([("a", None, 1, "s", 1e-9), ("a", "2", 1, "s", 0.5), ("a", "10", 1, "s", None), ("b", "3", 2, "t", 0.01)], schema)
    got = {r.disorder: r for r in M.derived_metrics(df, ["disorder"]).collect()}
    assert (got["a"].n_rows, got["a"].n_gwas, got["a"].pct_gwas) == (3, 1, 33.3333)
    assert (got["a"].chr_max_total, got["a"].chr_max_gwas) == ("10", L.NO_CHR)
    assert (got["b"].chr_max_gwas, got["b"].pct_nominal) == (L.NO_SIGNIFICANT_CHR, 100.0)
    summary = {r.disorder: r for r in M.dataset_summary(df).collect()}
    assert (summary["a"].n_chromosomes, summary["a"].n_empty_columns, summary["a"].n_columns) == (2, 0, 5)
    assert {r.chr: r.pct_of_all for r in M.chr_counts_share(df).collect()} == {"2": 25.0, "10": 25.0, "3": 25.0}
    assert {r.chr: r.pct for r in M.chr_distribution(df).collect()} == {"2": 33.33, "10": 33.33, "3": 33.33}
    assert [r.chr for r in M.chr_natural_order(df).orderBy("place").collect()] == ["2", "3", "10"]
    assert M.suggested_variant(df).first().snp is None  # no rs id
    assert M.suggested_variant(df.withColumn("snp", F.concat(F.lit("rs"), "pos"))).first().snp == "rs1"
    top = M.top_associations(df, 2).orderBy("rank").collect()
    assert [(r.rank, r.pval, r.neg_log10_p) for r in top] == [(1, 1e-9, 9.0), (2, 0.01, 2.0)]
    view = M.view_stats(df, df.filter("pval > 0.9")).first()
    assert (view.n_visible, view.n_gwas, view.n_chromosomes, view.top_snp) == (0, 0, 3, None)


# Profile --------------------------------------------------------------------------


def test_profile_counts_nan_as_null(spark):
    df = spark.createDataFrame([(float("nan"), "a", None), (1.0, "a", None), (None, "b", None), (1.0, None, None)], "x double, t string, e double")
    for exact in (True, False):
        got = {r.column: (r.n_non_null, r.n_null, r.pct_null, r.n_distinct, r.status) for r in P.column_profile(df, exact=exact).collect()}
        assert got == {"x": (2, 2, 50.0, 1, L.STATUS_HIGH), "t": (3, 1, 25.0, 2, L.STATUS_HIGH), "e": (0, 4, 100.0, 0, L.STATUS_EMPTY)}
    assert P.drop_empty_columns(df).columns == ["x", "t"]
    row = P.row_null_rate(df).first()
    assert (row.n_null_cells, row.n_null_columns, row.pct_rows_with_null) == (7, 3, 100.0)
    assert P.quality_kpis(df).first().mean_pct_null == 58.3


def test_profile_by_group_with_null_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1)], "g string, x int")
    assert {(r.g, r.n_distinct) for r in P.column_profile(df, ["g"]).collect()} == {("a", 2), (None, 1)}


def test_categorical_columns_at_the_limit(spark):
    df = spark.range(2000).select(*[(F.col("id") % k).cast("string").alias(f"c{k}") for k in (10, 500, 501, 2000)])
    got = P.categorical_value_counts(df, df.columns, 3, 500).collect()
    assert sorted((r.column, r.value, r.n) for r in got) == [
        ("c10", "0", 200), ("c10", "1", 200), ("c10", "2", 200), ("c500", "0", 4), ("c500", "1", 4), ("c500", "10", 4),
    ]


def test_glossary_keeps_unknown_headers(spark):
    profile = spark.createDataFrame([("Effect_Size",), ("my-col",)], "column string")
    terms = spark.createDataFrame([("effect size", "Effect")], "name_norm string, term string")
    got = {r.column: r.term for r in P.column_glossary(profile, terms).collect()}
    assert got == {"Effect_Size": "Effect", "my-col": "my col"}


# Annotation -----------------------------------------------------------------------


def test_traits_of_all_payload_shapes(spark):
    both = '{"_embedded":{"associations":[{"efoTraits":[{"trait":"b"},{"trait":"a"},{"x":1}],"diseaseTrait":{"trait":"a"}},{"diseaseTrait":{"trait":"c"}}]}}'
    shapes = [both, '{"_embedded":{"associations":[]}}', '{"page":1}', "not json", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "i int, j string")
    assert [r.traits for r in with_traits(df, "j").orderBy("i").collect()] == [["a", "b", "c"], [], [], [], []]


def test_variant_facts(spark):
    text = '{"name":"rs1","most_severe_consequence":"x_y","synonyms":[],"mappings":[{"allele_string":"A/G","location":"1:5-5"},{"location":"z"}]}'
    shapes = [text, "{}", None, '{"mappings": []}', "no json", "[1]", '{"synonyms": ["a"]}', '{"most_severe_consequence": null}', '{"mappings": 3}']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], "i int, j string").withColumn("id", F.lit("rs9"))
    rows = with_variant_facts(df, "j", "id").drop("id").orderBy("i").collect()
    for i in (3, 4, 5, 7, 8):
        assert tuple(rows[i])[2:] == (None, None, None, None), shapes[i]
    assert rows[6].gene == "rs9" and rows[6].alleles == L.NOT_AVAILABLE
    assert tuple(rows[0])[2:] == ("X y", "A/G", "rs1", "1:5-5")
    assert tuple(rows[1])[2:] == (L.UNKNOWN_CONSEQUENCE, L.NOT_AVAILABLE, L.UNKNOWN_GENE, L.NOT_AVAILABLE)
    assert tuple(rows[2])[2:] == (None, None, None, None)


def test_annotation_messages(spark):
    df = spark.createDataFrame([(" RS1",), ("rs2",), ("rs3",), ("chr1",), (None,)], "snp string")
    facts = spark.createDataFrame([("rs1", "x"), ("rs2", None)], "rsid string, fact string")
    got = {r.snp: (r.fact, r.message) for r in annotate(df, facts).collect()}
    assert got == {" RS1": ("x", None), "rs2": (None, L.MSG_EMPTY), "rs3": (None, L.MSG_NOT_FOUND), "chr1": (None, L.MSG_BAD_ID), None: (None, L.MSG_BAD_ID)}


# Manhattan feed -------------------------------------------------------------------


def test_manhattan_points(spark, v):
    points = manhattan_points(v, ["1", "X"], 2.0).orderBy("x").collect()
    assert [p.x for p in points] == list(range(len(points))) and all(p.y > 2 for p in points)
    assert len(points) == v.filter("chr IN ('1','X') AND pval < 0.01").count()
    assert [p.chr for p in points] == sorted((p.chr for p in points), key=lambda c: c == "X")
    assert manhattan_points(v, cap=50).count() == 50


# Files ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def folder(spark, v, tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    def put(df, name):
        df.toPandas().to_parquet(root / name, index=False, row_group_size=700)
    put(v.filter("disorder = 'adhd'"), "adhd.parquet")
    put(v.filter("disorder = 'bpd'").withColumnsRenamed({"pval": "P", "chr": "#CHR", "pos": "BP"}), "bpd.parquet")
    put(v.filter("disorder = 'ptsd'").drop("pval"), "ptsd.parquet")
    return str(root)


def test_load_many_headers(spark, v, folder):
    full = load(spark, folder)
    assert full.df.count() == v.count() and full.mode == "full" and full.roles.snp == "snp_id"
    assert {r.source_file: r["count"] for r in full.df.groupBy("source_file").count().collect()} == {
        f"{d}.parquet": v.filter(f"disorder = '{d}'").count() for d in ("adhd", "bpd", "ptsd")
    }
    assert full.df.filter("pval IS NOT NULL").count() == v.filter("disorder <> 'ptsd'").count()


def test_gwas_mode_falls_back_per_file(spark, v, folder):
    hits = load(spark, folder, "gwas")
    assert hits.fallback_files == ("ptsd.parquet",) and hits.mode == "gwas"
    assert hits.df.count() == v.filter("(disorder <> 'ptsd' AND pval < 5e-8) OR disorder = 'ptsd'").count()
    only = load(spark, f"{folder}/ptsd.parquet", "gwas")
    assert only.mode == "full" and only.df.count() == v.filter("disorder = 'ptsd'").count()


def test_samples_are_drawn_only_when_asked_for(spark, folder):
    path = f"{folder}/adhd.parquet"
    some = load(spark, path, "sample", cap=100)
    assert some.sampled and some.df.count() == 100
    for wrong in (("other", None), ("sample", None), ("full", 100)):
        with pytest.raises(ValueError):
            load(spark, path, wrong[0], cap=wrong[1])


def test_each_file_decides_how_its_effects_are_read(spark, tmp_path):
    import math

    from assocframe.operators.loci import cluster_loci

    def put(name, **columns):
        pd.DataFrame({"rsid": [f"rs_{name}"], "chr": ["1"], "pos": [5], "pval": [1e-9], "disorder": [name], **columns}).to_parquet(tmp_path / f"{name}.parquet")

    put("log", beta=[0.3])
    put("kind", effect_size=[1.5], effect_kind=["or"])
    put("direct", **{"or": [0.5], "chr": [1]})
    put("shown", effect=[7.0])
    data = load(spark, str(tmp_path))
    got = {r.disorder: (r.settled_or, r.shown_effect) for r in data.df.collect()}
    assert got["log"] == (pytest.approx(math.exp(0.3)), 0.3) and got["kind"] == (1.5, 1.5)
    assert got["direct"] == (0.5, 0.5) and got["shown"] == (None, 7.0)
    loci = {r.disorder: r.lead_or for r in cluster_loci(data.df).collect()}
    assert loci == {"log": 1.35, "kind": 1.5, "direct": 0.5, "shown": None}
    shown = {r.snp_id: r.shown_effect for r in M.top_associations(data.df, 9).collect()}
    assert shown == {"rs_log": 0.3, "rs_kind": 1.5, "rs_direct": 0.5, "rs_shown": 7.0}
    # One file alone, and files that state effects alike, get no further columns.
    assert "settled_or" not in load(spark, str(tmp_path / "log.parquet")).df.columns


def test_columns_of_one_name_and_several_types(spark, tmp_path):
    pd.DataFrame({"pval": [0.5], "chr": [1], "pos": [3], "x": [1], "y": [1]}).to_parquet(tmp_path / "a.parquet")
    pd.DataFrame({"pval": ["0.25"], "chr": ["X"], "pos": ["4"], "x": [0.5], "y": ["z"]}).to_parquet(tmp_path / "b.parquet")
    rows = sorted(load(spark, str(tmp_path)).df.collect(), key=lambda r: r.pos)
    assert [(r.pval, r.chr, r.pos, r.x, r.y) for r in rows] == [(0.5, "1", 3, 1.0, "1"), (0.25, "X", 4, 0.5, "z")]
    plot = load_plot_columns(spark, str(tmp_path)).df.orderBy("pos").collect()
    assert [(r.chr, r.pos, r.pval) for r in plot] == [("1", 3, 0.5), ("X", 4, 0.25)]
    assert sorted(read_many(spark, [str(tmp_path)]).toPandas()["pval"]) == ["0.25", "0.5"]


def test_nan_becomes_null_and_types_are_canonical(spark, tmp_path):
    pd.DataFrame({"pval": [float("nan"), 0.5], "chr": [1, 2], "pos": ["12", "x"]}).to_parquet(tmp_path / "a.parquet")
    rows = load(spark, str(tmp_path)).df.orderBy("chr").collect()
    assert [(r.pval, r.chr, r.pos) for r in rows] == [(None, "1", 12), (0.5, "2", None)]


def test_file_facts(spark, v, folder):
    blocks = file_blocks(spark, folder)
    totals = {r.file_name: r for r in file_totals(spark, folder).collect()}
    assert totals["adhd.parquet"].n_rows == v.filter("disorder = 'adhd'").count()
    assert (totals["adhd.parquet"].n_columns, totals["ptsd.parquet"].n_columns) == (10, 9)
    assert blocks.filter("file_name = 'adhd.parquet'").agg(F.sum("n_rows")).first()[0] == totals["adhd.parquet"].n_rows
    sizes = {r.file_name: r for r in file_sizes(spark, folder).collect()}
    assert sizes["bpd.parquet"].n_rows == totals["bpd.parquet"].n_rows and sizes["bpd.parquet"].mb > 0
    assert len(headers(spark, folder)) == 3 and len(headers(spark, f"{folder}/adhd.parquet")) == 1


def test_plot_columns(spark, v, folder):
    path = f"{folder}/bpd.parquet"
    want = v.filter("disorder = 'bpd'").count()
    whole = load_plot_columns(spark, path)
    assert not whole.sampled and whole.df.count() == want
    assert set(whole.df.columns) == {"chr", "pos", "pval", "snp_id", "maf", "neg_log10_p"}
    some = load_plot_columns(spark, path, "sample", cap=200)
    assert some.sampled and 195 <= some.df.count() <= 200
    assert load_plot_columns(spark, path, "gwas").df.count() == v.filter("disorder = 'bpd' AND pval < 5e-8").count()
    assert load_plot_columns(spark, f"{folder}/ptsd.parquet", "gwas").mode == "full"


def test_summary_per_file_with_sizes(spark, v, folder):
    sizes = file_sizes(spark, folder).select(F.col("file_name").alias("source_file"), "mb", F.col("n_rows").alias("file_rows"))
    rows = {r.source_file: r for r in M.dataset_summary(load(spark, folder).df, "source_file", sizes).collect()}
    assert len(rows) == 3 and all(r.mb > 0 and r.file_rows == r.n_rows for r in rows.values())
    assert rows["ptsd.parquet"].n_nominal == 0 and rows["ptsd.parquet"].n_empty_columns == 2


def test_read_many_and_roles_scan(spark, folder):
    assert "P" in read_many(spark, [folder]).columns
    assert set(scan_roles(spark, f"{folder}/bpd.parquet").columns) >= {"P", "#CHR", "BP"}


def test_csv_parts_are_one_ordered_file(spark, tmp_path):
    import csv

    rows = [(i % 97, f'say "{i}", é' if i % 3 else None, "" if i % 5 else " x ") for i in range(1000)] + [(None, "none", "a")]
    df = spark.createDataFrame(rows, "k int, `a.b` string, c string").repartition(7)
    path = tmp_path / "parts"
    manifest = sorted(write_csv_parts(df, str(path), ["k", "a.b"], rows=120).collect(), key=lambda r: r.part)
    assert [r.part for r in manifest] == list(range(1, len(manifest) + 1)) and max(r.n_rows for r in manifest) <= 120
    assert sum(r.n_rows for r in manifest) == 1001 and manifest[0].header == ["k", "a.b", "c"] and manifest[0].first_key == '{"a.b":"none"}'
    whole = "".join((path / r.file_name).read_text("utf-8") for r in manifest)
    keys = [(int(r[0]) if r[0] else -1, r[1]) for r in csv.reader(whole.splitlines())]
    assert len(keys) == 1001 and keys == sorted(keys)
    back = read_csv_parts(spark, str(path), df.schema)
    assert rows_of(back.drop("part")) == rows_of(df)


def test_csv_parts_of_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "k int, v string")
    assert write_csv_parts(df, str(tmp_path / "e"), ["k"]).isEmpty()
    assert read_csv_parts(spark, str(tmp_path / "e"), df.schema).isEmpty()


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "x int, t string")
    write_csv(df, str(tmp_path / "out"))
    assert rows_of(spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "out"))) == rows_of(df)
    assert len(to_pandas(df, 1)) == 1
