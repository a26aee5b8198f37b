import pytest

from assocframe.operators.summary import tier_counts
from assocframe.roles import MissingRole, canonicalize, resolve_roles, to_double, to_long
from pyspark.sql import functions as F


def test_roles_of_shouting_headers():
    r = resolve_roles(["P_VALUE", "CHROM", "BP", "SNP", "BETA", "SE", "EAF", "PHENOTYPE"])
    assert (r.pval, r.chr, r.pos, r.snp) == ("P_VALUE", "CHROM", "BP", "SNP")
    assert (r.effect, r.or_effect, r.se, r.maf, r.disorder) == ("BETA", "BETA", "SE", "EAF", "PHENOTYPE")
    assert r.info is None and r.direct_or is None


def test_odd_headers_and_direct_or():
    r = resolve_roles(["p.value", "#chr", "position", "rsid", "or"])
    assert (r.pval, r.chr, r.pos, r.snp) == ("p.value", "#chr", "position", "rsid")
    assert r.effect == "or" and r.or_effect is None and r.direct_or == "or"


def test_alias_order_decides_and_later_duplicate_wins():
    assert resolve_roles(["P", "Pval"]).pval == "Pval"
    assert resolve_roles(["raw_snp_id", "snp_id"]).snp == "snp_id"
    assert resolve_roles(["pval", "PVAL"]).pval == "PVAL"


def test_missing_role_is_named(spark):
    with pytest.raises(MissingRole, match="pval"):
        tier_counts(spark.range(3))


def test_odd_headers_work_in_operators(spark):
    df = spark.createDataFrame([(1e-9, "1"), (0.5, "2"), (None, "2")], "`p.value` double, `#chr` string")
    assert {r.tier: r.n for r in tier_counts(df).collect()} == {"Todas": 3, "p < 0.05": 1, "p < 1e-5": 1, "p < 5e-8": 1}


def test_canonical_names(spark):
    df = spark.createDataFrame([("rs1", "1", 5, 0.1, 0.2, 9)], "SNP string, CHROM string, BP int, `p.value` double, BETA double, other int")
    out = canonicalize(df)
    assert out.columns == ["snp_id", "chr", "pos", "pval", "effect_size", "other"]
    assert resolve_roles(out.columns).effect == "effect_size"


def test_coercion(spark):
    df = spark.createDataFrame([("12",), ("x",), ("",), (None,), ("12.0",), ("NaN",)], "t string")
    rows = df.select(to_double(F.col("t")), to_long(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [(12.0, 12), (None, None), (None, None), (None, None), (12.0, 12), (None, None)]
