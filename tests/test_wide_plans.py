"""Many files, dense integers, filtered annotation joins and the stored subset."""

import random
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assocframe.operators.annotate import annotate
from assocframe.operators.profile import _dense_columns, distinct_counts
from assocframe.plans.idfilter import could_match
from assocframe.sources import files as X
from assocframe.sources.stored import read_significant, store_significant


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Headers of many files ------------------------------------------------------------


def test_headers_of_many_files_ask_the_driver_per_header(spark, tmp_path, monkeypatch):
    kinds = [
        pa.table({"SNP": ["rs1"], "P": [0.5]}),
        pa.table({"rsid": ["rs2"], "pval": [0.25], "chr": pa.array([1], pa.int32())}),
        pa.table({"rsid": ["rs2"], "pval": [0.25], "chr": ["1"]}),
    ]
    for i in range(2000):
        pq.write_table(kinds[i % 3], f"{tmp_path}/{i:04d} ü.parquet")
    asked = []
    reader = type(spark.read)
    original = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *p, **o: asked.append(p) or original(self, *p, **o))
    found = X.headers(spark, str(tmp_path))
    assert len(asked) == 3
    assert sorted((tuple(s.names), s.fields[-1].dataType.simpleString(), len(f)) for s, f in found) == [
        (("SNP", "P"), "double", 667), (("rsid", "pval", "chr"), "int", 667), (("rsid", "pval", "chr"), "string", 666),
    ]
    assert sum(spark.read.parquet(*f).count() for _, f in found) == 2000


def test_many_files_of_one_header_keep_the_paths_given(spark, tmp_path):
    spark.range(60).repartition(20).write.parquet(f"{tmp_path}/t")
    assert [f for _, f in X.headers(spark, f"{tmp_path}/t")] == [[f"{tmp_path}/t"]]


def test_marks_tell_types_that_only_spark_tells_apart(spark, tmp_path):
    # Files of one schema by two writers may differ in marks, files of two schemas must.
    for name, kind in (("a", "string"), ("b", "varchar(3)"), ("c", "binary")):
        spark.sql(f"SELECT CAST('x' AS {kind}) AS v").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    marks = {n: X.header_mark(str(next((tmp_path / n).glob("*.parquet")))) for n in "abc"}
    assert marks["a"] != marks["c"] and marks["b"] != marks["c"]


def test_unknown_file_systems_have_no_mark():
    assert X.header_mark("nowhere-such://host/a.parquet") is None


# Distinct integers ----------------------------------------------------------------

EDGES = [-(2**63), 2**63 - 1, -32_769, -32_768, -32_767, -1, 0, 1, 32_767, 32_768, 32_769, None]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_distinct_integers_dense_and_sparse(spark, by):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.randrange(-500, 40_000), rng.getrandbits(60), rng.choice(EDGES)) for _ in range(6000)]
    data += [("a", None, None, e) for e in EDGES]
    df = spark.createDataFrame(data, "g string, near int, far long, edge long").repartition(3)
    got = {tuple(r[k] for k in by) + (r["column"],): r["n_distinct"] for r in distinct_counts(df, by).collect()}
    want = {}
    for g in {r[0] for r in data} if by else [None]:
        for k, name in enumerate(("near", "far", "edge"), 1):
            n = len({r[k] for r in data if (not by or r[0] == g) and r[k] is not None})
            want[(g, name) if by else (name,)] = n
    assert {k: v for k, v in got.items() if k[-1] != "g"} == want


def test_close_integers_travel_as_bitmaps(spark):
    df = spark.range(200_000, numPartitions=4).select(F.col("id"), (F.col("id") * 1_000_003).alias("far"), F.lit(None).cast("int").alias("none"))
    dense = _dense_columns(df, [], df.schema.fields)
    assert {r["column"]: r["_dense"] for r in dense.collect()} == {"id": True, "far": False, "none": False}
    near = df.select("id")
    assert "bitmap_construct_agg" in plan_of(distinct_counts(near))
    assert distinct_counts(near).collect()[0]["n_distinct"] == 200_000
    assert distinct_counts(df.limit(0)).collect() == []


# Annotation behind a filter -------------------------------------------------------


def test_filter_never_loses_an_id(spark):
    ids = spark.range(30_000).select(F.concat(F.lit("rs"), F.col("id") * 3).alias("rsid"))
    rows = spark.range(90_000).select(F.concat(F.lit("rs"), F.col("id")).alias("rsid")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    for blocks in (1, 64):
        told = could_match(rows, "rsid", ids, "rsid", blocks)
        assert told.filter("_maybe").join(ids, "rsid").count() == 30_000
        assert told.count() == 90_001 and told.filter("rsid is null and not _maybe").count() == 1
    # 90,000 bits set in 2 million: of the others, hardly any passes.
    assert told.filter("_maybe").count() < 30_600


def test_filtered_annotation_is_the_plain_one(spark):
    variants = [(f" RS{i % 40}" if i % 5 else None, i) for i in range(400)] + [("chr1:5", 400), ("", 401)]
    v = spark.createDataFrame(variants, "snp_id string, n int")
    facts = [(f"rs{i}", None if i % 3 else "x", None if i % 2 else i) for i in range(0, 40, 2)] + [(None, "never", 1)]
    a = spark.createDataFrame(facts, "rsid string, gene string, score int")
    plain, filtered = annotate(v, a, id_filter=False), annotate(v, a, id_filter=True)
    assert plain.columns == filtered.columns and bag(plain) == bag(filtered)
    assert bag(annotate(v, a.limit(0), id_filter=True)) == bag(annotate(v, a.limit(0), id_filter=False))
    assert annotate(v.limit(0), a, id_filter=True).isEmpty()


def test_rows_without_a_chance_are_not_shuffled(spark, tmp_path):
    spark.range(5000).select(F.concat(F.lit("rs"), "id").alias("snp_id")).write.parquet(f"{tmp_path}/v")
    spark.range(100).select(F.concat(F.lit("rs"), "id").alias("rsid"), F.lit("x").alias("gene")).write.parquet(f"{tmp_path}/a")
    v, a = spark.read.parquet(f"{tmp_path}/v"), spark.read.parquet(f"{tmp_path}/a")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = annotate(v, a)  # too large to broadcast, by this setting
        assert out.filter("gene is null").count() == 4900
        union = plan_of(out).split("Union", 1)[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    matched, apart = union.split("SortMergeJoin", 1)[1].rsplit("\n   :", 1)[0], union.rsplit("BroadcastHashJoin", 1)[1]
    assert "hashpartitioning(rsid" in matched
    # Below the last broadcast join: the scan, which is not exchanged, and the filter's blocks.
    assert "hashpartitioning(rsid" not in apart and "hashpartitioning(_block" in apart


# The stored subset ----------------------------------------------------------------

CHROMOSOMES = ["1", "01", "X", "chr/2 =%", "", None]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(5)
    rows = [(f"rs{i}", CHROMOSOMES[min(i % 11, 5)], rng.random() ** 3, i) for i in range(5000)] + [("rs7", "1", None, -1)]
    df = spark.createDataFrame(rows, "snp_id string, chr string, pval double, n int").repartition(5)
    path = f"{tmp_path_factory.mktemp('stored')}/t"
    store_significant(df, path, level=0.1)
    return rows, path


def test_stored_rows_come_back(spark, stored):
    rows, path = stored
    kept = [r for r in rows if r[2] is not None and r[2] < 0.1]
    order = lambda found: sorted(found, key=repr)
    assert bag(read_significant(spark, path)) == order(kept)
    for wanted in (["1"], ["01"], ["", "X"], ["chr/2 =%"], ["none"], []):
        assert bag(read_significant(spark, path, chromosomes=wanted)) == order([r for r in kept if r[1] in wanted])
    ids = ["rs5", "rs16", "rs4999", "rs7"]
    assert bag(read_significant(spark, path, level=0.01, ids=ids)) == order([r for r in kept if r[0] in ids and r[2] < 0.01])


def test_stored_files_are_pruned(spark, stored):
    _, path = stored
    read = read_significant(spark, path, chromosomes=["1"], level=0.01, ids=["rs5"])._jdf.queryExecution()
    plan = read.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(_chr" in plan or "PartitionFilters: [_chr" in plan
    for part in ("LessThan(pval,0.01)", "EqualTo(snp_id,rs5)"):
        assert part in plan
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for file in spark.read.parquet(path).select("_metadata.file_path").distinct().collect():
        source = spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(hadoop(unquote(file[0])), spark._jsc.hadoopConfiguration())
        reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        columns = reader.getFooter().getBlocks().get(0).getColumns()
        offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in columns}
        reader.close()
        assert offsets["snp_id"] > 0 and offsets["n"] <= 0
    ordered = spark.read.parquet(path).select("_metadata.file_path", "pval").collect()
    last = {}
    for file, p in ordered:
        assert last.get(file, 0.0) <= p
        last[file] = p


def test_stored_refuses_the_folder_name(spark, tmp_path):
    df = spark.createDataFrame([("1", 0.0, "a")], "chr string, pval double, _chr string")
    with pytest.raises(ValueError):
        store_significant(df, f"{tmp_path}/t")
    store_significant(df.drop("_chr").limit(0), f"{tmp_path}/none")
