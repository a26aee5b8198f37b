"""The pipeline stage by stage against what each stage's operator says, and the whole against its contract."""

import corpus_pipeline as P
from assocframe.llm import bytecnn, quality, simhash
from assocframe.llm.mixing import decisions, sizes


def bag(df):
    found = {}
    for r in df.collect():
        key = tuple(r)
        found[key] = found.get(key, 0) + 1
    return found


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [name for name, _ in P.STAGES] == ["quality_rules", "language_id", "near_dedup", "source_mixing", "best_fit_packing"]
    kept = [docs]
    for name, stage in P.STAGES:
        stage(spark, kept[-1], small).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(df.columns == docs.columns for df in kept[:5])
    rules = quality.quality_rules(docs, quality.learn_rules(docs, spark.read.parquet(f"{small}/labels.parquet")))
    good = {r["doc_id"] for r in rules.filter("kept").collect()}
    assert {r["doc_id"] for r in kept[1].collect()} == good
    model = bytecnn.learn_languages(kept[1], ~bytecnn.held_out_fold())
    known = bytecnn.identify(kept[1], model).filter(f"lang_pred <> 'und' and score >= {P.MIN_LANGUAGE_SCORE}")
    assert {r["doc_id"] for r in kept[2].collect()} == {r["doc_id"] for r in known.collect()}
    groups = simhash.near_duplicates(kept[2])
    assert bag(kept[3].select("doc_id")) == {(r["component_id"],): 1 for r in groups.collect()}
    copies = {r["doc_id"]: r["rows"] * r["copies"] + r["extra"] for r in decisions(sizes(kept[3])).collect()}
    assert bag(kept[4].select("doc_id")) == {(d,): n for d, n in copies.items() if n}
    pieces = bag(kept[5].filter("piece = 0").select("doc_id"))
    assert pieces == bag(kept[4].select("doc_id"))
    rows = kept[5].groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in rows) <= 4096


def test_run_gives_the_last_stage(spark, small):
    assert P.run(spark, small).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_empty_table(spark, tmp_path, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.isEmpty()


def test_odd_documents(spark, odd, small, tmp_path):
    """NULLs, empty and very long texts, repeated rows and clashing columns go through all stages."""
    docs = odd
    for name, stage in P.STAGES:
        before = docs.columns
        stage(spark, docs, small).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != P.STAGES[-1][0]:
            assert docs.columns == before
        if name == "quality_rules":
            assert docs.filter("text is null or trim(text) = ''").isEmpty()
    assert docs.filter("length > 4096").isEmpty()
