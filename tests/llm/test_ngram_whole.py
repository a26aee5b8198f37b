from pyspark.sql import functions as F

from assocframe.llm import ngram as N


def test_ngrams_seen_once_are_kept(spark, docs):
    texts = [r["text"] for r in docs.select("text").limit(60).collect()] + ["once upon a time", None, ""]
    grams = [set(), set(), set()]
    for text in texts:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        tokens = [N.END, *lower.encode().split(), N.END]
        grams[0] |= set(tokens)
        grams[1] |= set(zip(tokens, tokens[1:], strict=False))
        grams[2] |= set(zip(tokens, tokens[1:], tokens[2:], strict=False))
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model = N.train(df)
    assert [int(level.starts[-1]) for level in model.levels] == [len(g) for g in grams]
    asked = spark.createDataFrame([(1, "once upon a time"), (2, "time a upon once")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in N.score_documents(asked, model, F.lit(True)).collect()}
    assert score[1] > score[2] + 1
