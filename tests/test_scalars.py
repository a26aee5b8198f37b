import math

from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.functions import scalars as S


def one(spark, column, row, schema):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first().x


def test_odds_ratio_kinds(spark):
    df = spark.createDataFrame(
        [(0.1, "log_or"), (0.1, "LOG_OR"), (1.2, "or"), (1.2, None), (None, "or")], "e double, k string"
    )
    got = [r.x for r in df.select(S.odds_ratio(F.col("e"), F.col("k")).alias("x")).collect()]
    assert got[:2] == [math.exp(0.1)] * 2 and got[2:] == [1.2, 1.2, None]
    assert one(spark, S.odds_ratio(F.col("e")), (0.5,), "e double") == math.exp(0.5)
    assert one(spark, S.odds_ratio(None, None, F.col("d")), (1.5,), "d double") == 1.5
    assert one(spark, S.odds_ratio(None), (1.5,), "d double") is None


def test_interpretation(spark):
    df = spark.createDataFrame([(None,), (1.0,), (1.5,), (0.75,), (1.125,), (1.375,)], "o double")
    assert [r.x for r in df.select(S.interpret_or(F.col("o")).alias("x")).collect()] == [
        "—", "Sin efecto aparente", "↑ riesgo ~50%", "↓ riesgo ~25% (protector)", "↑ riesgo ~12%", "↑ riesgo ~38%",
    ]


def test_log_forms(spark):
    df = spark.createDataFrame([(0.0,), (0.01,), (None,), (1e-310,)], "p double")
    rows = df.select(S.neg_log10_inf(F.col("p")).alias("i"), S.neg_log10_floor(F.col("p")).alias("f")).collect()
    assert rows[0].i == math.inf and rows[0].f == 300.0
    assert abs(rows[1].i - 2) < 1e-12 and rows[2].i is None and rows[3].f == 300.0


def test_natural_order(spark):
    df = spark.createDataFrame([(c,) for c in ["X", "10", "2", None, "MT", "1"]], "c string")
    assert [r.c for r in df.orderBy(*S.chr_order(F.col("c"))).collect()] == ["1", "2", "10", "MT", "X", None]


def test_bands(spark):
    df = spark.createDataFrame([(100.0, 1.0), (99.99, 1.05), (20.0, 1.2), (20.01, 1.0999)], "n double, l double")
    rows = df.select(S.null_band(F.col("n")).alias("a"), S.inflation_band(F.col("l")).alias("b")).collect()
    assert [r.a for r in rows] == [L.STATUS_EMPTY, L.STATUS_HIGH, L.STATUS_OK, L.STATUS_HIGH]
    assert [r.b for r in rows] == [L.INFLATION_NONE, L.INFLATION_LIGHT, L.INFLATION_STRONG, L.INFLATION_LIGHT]


def test_percent_and_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 0), (3, 60000)], "a int, b int")
    assert [r.x for r in df.select(S.percent(F.col("a"), F.col("b"), 2).alias("x")).collect()] == [12.5, None, 0.0]


def test_texts(spark):
    assert one(spark, S.consequence_label(F.col("c")), ("intron_variant",), "c string").startswith("Variante en intr")
    assert one(spark, S.consequence_label(F.col("c")), ("stop_GAINED",), "c string") == "Stop gained"
    assert one(spark, S.consequence_label(F.col("c")), (None,), "c string") == "Desconocida"
    assert one(spark, S.rsid_normal(F.col("c")), ("  RS12 ",), "c string") == "rs12"
    assert one(spark, S.rsid_normal(F.col("c")), ("chr1",), "c string") is None
    assert one(spark, S.header_normal(F.col("c")), ("Effect_size-X",), "c string") == "effect size x"
    assert one(spark, S.region_label(F.col("a"), F.col("b")), (1_234_567, 2_000_000), "a long, b long") == "1.23–2.00 Mb"
    assert one(spark, S.log1p_clipped(F.col("c")), (-5.0,), "c double") == 0.0
    assert one(spark, S.percent_text(F.col("c"), 4), (0.3495,), "c double") == "0.3495%"
