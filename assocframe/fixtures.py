"""A variants table derived from ``lineitem``, for queries and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DISORDERS = ("adhd", "bpd", "ptsd")

_VARIANTS = """
SELECT CASE WHEN l_linenumber % 5 = 0 THEN concat('chr', CAST(l_partkey AS {text}))
            ELSE concat('rs', CAST(l_partkey * 10 + l_linenumber AS {text})) END AS variant_id,
       CASE CAST(l_suppkey % 6 AS INT) WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '10'
            WHEN 3 THEN '21' WHEN 4 THEN 'X' END AS chr,
       1000000 + (l_partkey % 4) * 2000000
         + (l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 600001 AS pos,
       u * u * u AS pval,
       CASE WHEN l_linestatus = 'F' THEN l_discount - 0.05 ELSE 1.0 + (l_discount - 0.05) END AS effect_size,
       CASE WHEN l_linestatus = 'F' THEN 'log_or' ELSE 'or' END AS effect_kind,
       l_tax + 0.01 AS se,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 100 END AS maf,
       CAST(NULL AS DOUBLE) AS info,
       CASE l_returnflag WHEN 'A' THEN 'adhd' WHEN 'N' THEN 'bpd' ELSE 'ptsd' END AS disorder{extra}
FROM (SELECT *, CAST((l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709
                      + l_linenumber * 15485863) % 1000003 + 1 AS DOUBLE) / 1000003 AS u
      FROM {source}) t
"""

# Identifies a row; used as the key of samples.
_ROW_KEY = (
    ", concat_ws('-', CAST(l_orderkey AS {text}), CAST(l_partkey AS {text}),"
    " CAST(l_suppkey AS {text}), CAST(l_linenumber AS {text})) AS row_key"
)


def variants_sql(text: str = "VARCHAR", source: str = "lineitem", row_key: bool = False) -> str:
    extra = _ROW_KEY.format(text=text) if row_key else ""
    return _VARIANTS.format(text=text, source=source, extra=extra)


def variants(spark: SparkSession, sf_dir: str, row_key: bool = False) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(variants_sql("STRING", "{lineitem}", row_key), lineitem=lineitem)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
