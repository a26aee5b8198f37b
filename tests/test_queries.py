"""Every named query against its check SQL, on the smallest data."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import compare, open_duckdb


@pytest.fixture(scope="module")
def con(small):
    return open_duckdb(small)


def test_entry(spark):
    assert entry(spark).count() == 20


def test_checks_name_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, small, name):
    df = queries()[name](spark, small)
    if name in oracle_sql():
        assert compare(df, con.sql(oracle_sql()[name])) is None
    else:
        assert df.count() > 0


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 2000)
    return df._jdf.queryExecution().toString()


def test_level_filter_reaches_the_scan(spark, tmp_path, v):
    from assocframe.operators.filters import association_filter, level_filter
    from assocframe.sources.load import load, scan_roles

    path = str(tmp_path / "v")
    v.write.parquet(path)
    stored = spark.read.parquet(path)
    assert "LessThan(pval,1.0E-5)" in plan(level_filter(stored, 1e-5))
    both = plan(association_filter(stored, "bpd", 1e-5, 0.1).select("variant_id"))
    assert "EqualTo(disorder,bpd)" in both and "LessThan(pval,1.0E-5)" in both
    assert re.search(r"ReadSchema: struct<variant_id:string,pval:double,effect_size:double,disorder:string>", both)
    assert "LessThan(pval,5.0E-8)" in plan(load(spark, path, "gwas").df)
    assert "LessThan(pval,0.05)" in plan(load(spark, path, level=0.05).df)
    assert "n_extra" not in plan(scan_roles(spark, path))


def test_counts_read_one_column_once(spark, tmp_path, v):
    from assocframe.operators.summary import derived_metrics, tier_counts

    path = str(tmp_path / "v")
    v.write.parquet(path)
    stored = spark.read.parquet(path)
    tiers = plan(tier_counts(stored)).split("== Physical Plan ==")[1]
    assert tiers.count("FileScan") == 1 and "ReadSchema: struct<pval:double>" in tiers
    metrics = plan(derived_metrics(stored, ["disorder"])).split("== Physical Plan ==")[1]
    assert metrics.count("FileScan") == 1 and "ReadSchema: struct<chr:string,pval:double,disorder:string>" in metrics


def test_loci_reduce_cells_before_any_window(spark, tmp_path, v):
    from assocframe.operators.loci import cluster_loci

    path = str(tmp_path / "v")
    v.write.parquet(path)
    text = cluster_loci(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(pval,5.0E-8)" in text and "SinglePartition" not in text
    # Deepest in the plan: partial aggregate of cells, below the first window.
    assert text.rindex("partial_min") > text.rindex("Window")


def test_overlap_is_an_equi_join(v):
    from assocframe.operators.loci import cluster_loci
    from assocframe.operators.overlap import overlap_loci

    text = overlap_loci(cluster_loci(v))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
