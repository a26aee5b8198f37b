"""The queries of the training-data operators over the whole test tables, with their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocframe.llm import bytecnn, hnsw, middle, mixing, ngram, packing, quality, quotes, repair, simhash, syncmers, warc, wavelet
from assocframe.llm.common import documents, fold_of
from assocframe.llm.encoding import vocabulary
from assocframe.plans.materialize import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality_rules(docs, model)


@query("op2_source_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = materialize(mixing.sizes(documents(spark, sf_dir)))
    mixed = mixing.mix(sized, mixing.decisions(sized))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


@query("op3_wavelet_matrix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = wavelet.write_shards(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
    return wavelet.with_starts(wavelet.read_shards(spark, folder), manifest)


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = bytecnn.held_out_fold()
    return bytecnn.identify(docs, bytecnn.learn_languages(docs, ~held_out), held_out)


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


@query("op6_quotation_linking")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op7_ngram_trie")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold_of("doc_id", 7) == 2
    return ngram.score_documents(docs, ngram.train(docs.filter(~held_out).select("text")), held_out)


@query("op8_syncmer_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_likeness(documents(spark, sf_dir))


_OP9 = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
  m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p),
  r AS (SELECT *, CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to FROM m)
  SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r"""


@query("op9_warc_zstd", _OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, written = warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return warc.read_archives(spark, folder, manifest=materialize(written))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, sf_dir), vocabulary("word_bpe_49k.json")))


_OP11 = """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
  u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
  c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
  p AS (SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:n], '') AS suffix FROM c)
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""


@query("op11_fill_in_middle", _OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = middle.fill_in_middle(documents(spark, sf_dir))
    digests = [F.sha2(c.cast("binary"), 256).alias(f"{name}_sha256") for name, c in (("output", F.col("output")), ("restored", middle.restored_text()))]
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query("op12_nearest_neighbours")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hnsw.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return hnsw.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair.with_all_ids(repair.repair_conversations(repair.damage(rows)), rows)
