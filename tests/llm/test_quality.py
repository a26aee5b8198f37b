import random
import re

import numpy as np
from pyspark.sql import functions as F

from assocframe.llm import quality as Q


def plain(text):
    """The base counts by the contract's words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in lines
            lines.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return [len(words), sum(map(len, words)), symbols, copies, len(hit)]


def test_base_counts_match_plain_ones():
    rng = random.Random(3)
    cases = [None, "", " ", "a", "a a a", "a a a a", "a b c a b c", "x\n\nx\n x\nx", "é ü #|<> a"]
    cases += ["".join(rng.choice(["a ", "b ", "é ", "\n", "\t", "*", "c d e ", " "]) for _ in range(n)) for n in range(80)]
    for text in cases:
        assert Q.statistics(text)[0] == plain(text), repr(text)


def test_scores_follow_directions_and_flat_arrays_match_the_nodes():
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, (800, 3))
    y = ((x[:, 0] + 0.05 * rng.normal(size=800) < 0.5) & (x[:, 2] > 0.2)).astype(float)
    model = Q.boost(x, y, [-1, 0, 1], trees=20)
    assert ((model.score(x) > 0.5) == y).mean() > 0.85
    line = np.repeat(rng.uniform(0, 1, (50, 1, 3)), 30, axis=1)
    for j, sign in ((0, -1), (2, 1)):
        moved = line.copy()
        moved[:, :, j] = np.linspace(-0.5, 1.5, 30)
        scores = model.score(moved.reshape(-1, 3)).reshape(50, 30)
        assert (np.diff(scores, axis=1) * sign >= -1e-12).all()

    def walk(row):
        total = model.start
        for node in model.roots:
            while model.left[node] != node:
                node = (model.left if row[model.feature[node]] <= model.threshold[node] else model.right)[node]
            total += model.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x[:40]), [walk(r) for r in x[:40]])


def test_labels_are_learned_and_base_rule_holds(spark, small, docs):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    found = Q.quality_rules(docs, Q.learn_rules(docs, labels))
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert [r[c] for c in Q.BASE] == plain(r["text"])
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    right = found.join(labels, "doc_id").filter("not base_failed").select((F.col("kept") == (F.col("quality") > 0)).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.97


def test_odd_documents(spark, odd, none):
    labels = spark.createDataFrame([(8, 1), (8, None), (None, 1), (99, 0)], "doc_id long, quality int")
    model = Q.learn_rules(odd, labels)
    found = Q.quality_rules(odd, model)
    assert found.count() == odd.count()
    assert found.filter("n_words = 0 and kept").isEmpty()
    kept = Q.keep_quality(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {11}
    assert Q.quality_rules(none, Q.learn_rules(none, labels.limit(0))).isEmpty()
    assert Q.keep_quality(none, model).isEmpty()


def test_training_is_bounded(spark, docs, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    assert len(Q.learn_rules(docs, labels, max_labelled=1).roots) == 0  # one row has one class: nothing to boost
