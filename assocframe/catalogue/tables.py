"""Scans, files, typed filters, export and annotation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assocframe import labels as L
from assocframe.catalogue.registry import query, with_v
from assocframe.fixtures import table, variants
from assocframe.functions.scalars import consequence_label
from assocframe.operators.annotate import annotate, with_traits, with_variant_facts
from assocframe.operators.filters import (
    category_filter,
    first_rows,
    range_filter,
    rows_indexed,
    rsid_column,
    text_filter,
    typed_filter,
)
from assocframe.plans.materialize import shared_dir
from assocframe.roles import to_double
from assocframe.sources.csv_parts import read_csv_parts, write_csv_parts
from assocframe.sources.files import file_blocks, file_sizes, file_totals
from assocframe.sources.load import read_many, scan, write_csv
from assocframe.sources.stored import read_significant, store_significant

# Filters --------------------------------------------------------------------------


@query("range_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 50000 AND 150000")
def range_filter_(spark, sf):
    return range_filter(table(spark, sf, "orders"), "o_totalprice", 50_000, 150_000).select("o_orderkey", "o_totalprice")


@query("category_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def category_filter_(spark, sf):
    chosen = category_filter(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return chosen.select("o_orderkey", "o_orderpriority")


@query("text_filter", "SELECT doc_id, lang, n_chars FROM documents WHERE regexp_matches(text, '(?i)licen[sc]e|copyright')")
def text_filter_(spark, sf):
    return text_filter(table(spark, sf, "documents"), "text", "licen[sc]e|copyright").select("doc_id", "lang", "n_chars")


@query("text_filter_literal", "SELECT doc_id, lang, n_chars FROM documents WHERE contains(lower(text), 'e.g')")
def text_filter_literal(spark, sf):
    return text_filter(table(spark, sf, "documents"), "text", "E.G", literal=True).select("doc_id", "lang", "n_chars")


@query(
    "typed_filter",
    """SELECT p_partkey, p_name, p_type, p_size FROM part
       WHERE p_size BETWEEN 5 AND 40 AND p_type IN ('ECONOMY', 'SMALL') AND regexp_matches(p_name, '(?i)RING')
         AND regexp_matches(p_type, '(?i)o')""",
)
def typed_filter_(spark, sf):
    part = table(spark, sf, "part")
    part = typed_filter(part, "p_size", low=5, high=40)
    part = typed_filter(part, "p_type", values=["ECONOMY", "SMALL"])
    part = typed_filter(part, "p_type", text="o")
    return typed_filter(part, "p_name", text="RING").select("p_partkey", "p_name", "p_type", "p_size")


@query("first_rows", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 500")
def first_rows_(spark, sf):
    return first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), ["o_orderkey"], 500)


@query(
    "rows_indexed",
    "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index, o_totalprice AS value FROM orders",
)
def rows_indexed_(spark, sf):
    return rows_indexed(table(spark, sf, "orders"), ["o_orderkey"], "o_totalprice")


@query(
    "numeric_coercion",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         TRY_CAST(event_type AS DOUBLE) AS not_a_number FROM events""",
)
def numeric_coercion(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        to_double(F.get_json_object("props", "$.k")).alias("k"),
        to_double(F.col("event_type")).alias("not_a_number"),
    )


@query(
    "rsid_normal_form",
    with_v("SELECT variant_id, pos, CASE WHEN lower(trim(variant_id)) LIKE 'rs%' THEN lower(trim(variant_id)) END AS rsid FROM V"),
)
def rsid_normal_form(spark, sf):
    return rsid_column(variants(spark, sf)).select("variant_id", "pos", "rsid")


# Scans and files ------------------------------------------------------------------


@query("parquet_scan_pruned", "SELECT l_orderkey, l_quantity, l_discount FROM lineitem")
def parquet_scan_pruned(spark, sf):
    return scan(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_discount"])


_UNION = ("customer", "orders", "lineitem")
_UNION_KEYS = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}


@query(
    "multi_file_union",
    " UNION ALL ".join(
        f"""SELECT '{t}.parquet' AS source_file, count(*) AS n_rows,
              CAST({'sum(c_custkey)' if t == 'customer' else 'NULL'} AS BIGINT) AS customer_keys,
              CAST({'sum(o_orderkey)' if t == 'orders' else 'NULL'} AS BIGINT) AS order_keys,
              CAST({'sum(l_orderkey)' if t == 'lineitem' else 'NULL'} AS BIGINT) AS line_keys FROM {t}"""
        for t in _UNION
    ),
)
def multi_file_union(spark, sf):
    both = read_many(spark, [f"{sf}/{t}.parquet" for t in _UNION], list(_UNION_KEYS.values()))
    return both.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("c_custkey").alias("customer_keys"),
        F.sum("o_orderkey").alias("order_keys"),
        F.sum("l_orderkey").alias("line_keys"),
    )


@query(
    "file_blocks",
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows FROM {t}" for t in _UNION),
)
def file_blocks_(spark, sf):
    """Blocks of these small files are whole files."""
    return file_blocks(spark, [f"{sf}/{t}.parquet" for t in _UNION]).select("file_name", "n_rows")


@query("file_sizes")
def file_sizes_(spark, sf):
    return file_sizes(spark, [f"{sf}/{t}.parquet" for t in _UNION])


@query(
    "file_row_totals",
    " UNION ALL ".join(
        f"""SELECT '{t}.parquet' AS file_name, count(*) AS n_rows, CAST({n} AS INTEGER) AS n_columns FROM {t}"""
        for t, n in (("customer", 5), ("orders", 6), ("lineitem", 11))
    ),
)
def file_row_totals(spark, sf):
    return file_totals(spark, [f"{sf}/{t}.parquet" for t in _UNION])


@query("csv_roundtrip", "SELECT * FROM part WHERE p_size BETWEEN 10 AND 30")
def csv_roundtrip(spark, sf):
    part = range_filter(table(spark, sf, "part"), "p_size", 10, 30)
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(part, path)
    return spark.read.option("header", "true").schema(part.schema).csv(path)


@query(
    "csv_ordered_parts",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, true AS in_order FROM lineitem""",
)
def csv_ordered_parts(spark, sf):
    """Rows of an ordered export, and whether each lies between the first keys of its part and of the next one."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    manifest = write_csv_parts(lines, path, ["l_orderkey", "l_linenumber"], rows=10_000)
    key = "l_orderkey long, l_linenumber int"
    starts = manifest.select("part", F.from_json("first_key", key).alias("low"))
    ends = starts.select((F.col("part") - 1).alias("part"), F.col("low").alias("high"))
    bounds = F.broadcast(starts.join(ends, "part", "left"))  # a row per file
    own = F.struct(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"))
    within = (own >= F.col("low")) & (F.col("high").isNull() | (own <= F.col("high")))
    return read_csv_parts(spark, path, lines.schema).join(bounds, "part").select(*lines.columns, within.alias("in_order"))


def _stored(spark, sf):
    path = f"{shared_dir(spark)}/significant-{uuid.uuid4().hex}"
    store_significant(variants(spark, sf), path, level=1e-2)
    return path


_STORED = "SELECT variant_id, chr, pos, pval, disorder FROM V WHERE pval < 0.01 AND "


@query("significant_stored", with_v(_STORED + "pval < 0.001 AND chr IN ('1', '10', 'X')"))
def significant_stored(spark, sf):
    """Chromosomes below a stricter level, from the stored subset."""
    rows = read_significant(spark, _stored(spark, sf), chromosomes=["1", "10", "X"], level=1e-3)
    return rows.select("variant_id", "chr", "pos", "pval", "disorder")


_STORED_IDS = [f"rs{part * 10 + line}" for part in (7, 40, 77, 120) for line in (1, 2)]


@query("significant_stored_ids", with_v(_STORED + f"variant_id IN ({', '.join(map(repr, _STORED_IDS))})"))
def significant_stored_ids(spark, sf):
    """Variants by id, from the stored subset; rows without a chromosome are there too."""
    rows = read_significant(spark, _stored(spark, sf), ids=_STORED_IDS)
    return rows.select("variant_id", "chr", "pos", "pval", "disorder")


# Annotation -----------------------------------------------------------------------

_CODES = (*L.CONSEQUENCES, "splice_region_variant")


_CODE_SQL = (
    f"CASE p_size % {len(_CODES) + 1} "
    + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(_CODES))
    + " END"
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _label_sql(code: str) -> str:
    known = " ".join(f"WHEN '{c}' THEN {_quoted(v)}" for c, v in L.CONSEQUENCES.items())
    readable = f"replace(coalesce({code}, 'Desconocida'), '_', ' ')"
    return f"CASE {code} {known} ELSE upper(left({readable}, 1)) || lower(substr({readable}, 2)) END"


@query(
    "consequence_labels",
    f"SELECT p_partkey, {_CODE_SQL} AS code, {_label_sql(_CODE_SQL)} AS label FROM part",
)
def consequence_labels(spark, sf):
    coded = table(spark, sf, "part").select("p_partkey", F.expr(_CODE_SQL).alias("code"))
    return coded.withColumn("label", consequence_label(F.col("code")))


_ANNOTATIONS = """SELECT concat('rs', CAST(p_partkey * 10 + 1 + p_size % 4 AS {text})) AS rsid,
                    CASE WHEN p_size % 7 <> 0 THEN p_type END AS consequence,
                    CASE WHEN p_size % 7 <> 0 THEN p_brand END AS location FROM {source}"""


_ANNOTATED = with_v(
    """SELECT v.variant_id, v.pos, v.disorder, v.rsid, a.consequence, a.location,
         CASE WHEN v.rsid IS NULL THEN 'El ID debe tener el formato estándar ''rs...'' (ej. rs11210887).'
              WHEN a.rsid IS NULL THEN 'Variante sin registros clínicos en la base de datos.'
              WHEN a.consequence IS NULL AND a.location IS NULL
              THEN 'La variante existe, pero no tiene información clínica mapeada.' END AS message
       FROM (SELECT *, CASE WHEN lower(trim(variant_id)) LIKE 'rs%' THEN lower(trim(variant_id)) END AS rsid FROM V) v
       LEFT JOIN A a ON v.rsid = a.rsid""",
    "A AS (" + _ANNOTATIONS.format(text="VARCHAR", source="part") + ")",
)


def _annotated(spark, sf, id_filter):
    part = table(spark, sf, "part")
    annotations = spark.sql(_ANNOTATIONS.format(text="STRING", source="{part}"), part=part)
    out = annotate(variants(spark, sf), annotations, id_filter=id_filter)
    return out.select("variant_id", "pos", "disorder", "rsid", "consequence", "location", "message")


@query("annotate_variants", _ANNOTATED)
def annotate_variants(spark, sf):
    return _annotated(spark, sf, None)


@query("annotate_variants_filtered", _ANNOTATED)
def annotate_variants_filtered(spark, sf):
    """The form for annotations too large to broadcast."""
    return _annotated(spark, sf, True)


_PAYLOAD = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN '{"error": "none"}'
  ELSE concat('{"_embedded": {"associations": [{"efoTraits": [{"trait": "', o_orderpriority, '"}, {"trait": "',
              o_orderstatus, '"}], "diseaseTrait": {"trait": "', o_orderpriority, '"}}, {"efoTraits": [], "diseaseTrait": {"trait": "',
              concat('T', CAST(o_custkey % 5 AS STRING)), '"}}]}}') END"""


@query(
    "trait_list_json",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 11 < 2 THEN '' ELSE array_to_string(list_sort(list_distinct(list_concat(
          json_extract_string(payload, '$._embedded.associations[*].efoTraits[*].trait'),
          json_extract_string(payload, '$._embedded.associations[*].diseaseTrait.trait')))), '|') END AS traits
        FROM (SELECT o_orderkey, {_PAYLOAD.replace('STRING', 'VARCHAR')} AS payload FROM orders) o""",
)
def trait_list_json(spark, sf):
    payloads = table(spark, sf, "orders").select("o_orderkey", F.expr(_PAYLOAD).alias("payload"))
    return with_traits(payloads, "payload").select("o_orderkey", F.array_join("traits", "|").alias("traits"))


_FACTS = """concat(CASE WHEN p_size % 13 = 0 THEN 'no json' ELSE '' END, '{', CASE WHEN p_size % 11 = 0 THEN ''
  ELSE concat('"name": "', p_name, '", ') END, '"most_severe_consequence": "', CASE WHEN p_size % 2 = 0 THEN 'missense_variant'
  ELSE 'stop_gained' END, '"', CASE WHEN p_size % 3 = 0 THEN ', "synonyms": ["a"]' ELSE '' END, ', "mappings": [',
  CASE WHEN p_size % 5 = 0 THEN '' ELSE concat('{"allele_string": "A/G", "location": "', p_brand, '"}') END, ']}')"""


@query(
    "variant_facts_json",
    """WITH x AS (SELECT *, p_size % 13 <> 0 AND p_size % 5 <> 0 AS known FROM part)
       SELECT p_partkey, CASE WHEN known THEN CASE WHEN p_size % 2 = 0 THEN 'Variante de cambio de sentido' ELSE 'Stop gained' END END AS consequence,
         CASE WHEN known THEN 'A/G' END AS alleles,
         CASE WHEN known THEN CASE WHEN p_size % 3 <> 0 THEN 'Desconocido' WHEN p_size % 11 = 0 THEN 'rs' || p_partkey ELSE p_name END END AS gene,
         CASE WHEN known THEN p_brand END AS location FROM x""",
)
def variant_facts_json(spark, sf):
    payload, rsid = F.expr(_FACTS).alias("payload"), F.concat(F.lit("rs"), F.col("p_partkey").cast("string")).alias("rsid")
    payloads = table(spark, sf, "part").select("p_partkey", payload, rsid)
    return with_variant_facts(payloads, "payload", "rsid").drop("payload", "rsid")
