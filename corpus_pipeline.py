"""Documents to training sequences: five operators in a row, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents its
predecessor kept.  All but the last return the columns of ``documents``.

Odd cases, stage by stage: a NULL or empty text fails the base rules, so it goes
first; it would also have no language.  Rows that repeat one document count as
one from near_dedup on; before it each is judged alike.  A NULL id is an id like
any other, a NULL source a source of its own.  Where two documents of a group
tie, the one of the smaller id, then text hash, stays.  Very long texts are read
whole by every stage and cut only by the last one, into pieces of a sequence's
length.  Extra columns are carried along under any name, and an empty table goes
through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assocframe.llm import bytecnn, mixing, packing, quality, simhash
from assocframe.llm.common import new_folder
from assocframe.llm.encoding import vocabulary

MIN_LANGUAGE_SCORE = 0.4


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the trees go."""
    model = quality.learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_quality(docs, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    model = bytecnn.learn_languages(docs, ~bytecnn.held_out_fold())
    return bytecnn.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group whose fingerprints are linked by 3 or fewer differing bits (3-word shingles)."""
    return simhash.keep_one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as the mix takes it: not at all, or up to three times."""
    return mixing.take_mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(packing.pieces(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: The trees, the network and the packing order have no SQL form; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
