import numpy as np
import pytest
from pyspark.sql import functions as F

from assocframe.llm import bytecnn as B


def test_windows_cover_every_byte_group():
    for n in (0, 1, 5, 125, 126, 127, 128, 129, 252, 253, 254, 1000):
        text = "".join(chr(97 + i % 23) for i in range(n))
        windows, used = B.cut_windows(text)
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        seen = set()
        for k, (w, u) in enumerate(zip(windows, used, strict=True)):
            at = k * B._STEP
            assert w[: int(u)].tolist() == data[at : at + B.WINDOW].tolist() and not w[int(u) :].any()
            seen |= {at + j for j in range(int(u) - 3)}
        assert seen >= set(range(n - 3))


def test_folded_table_is_the_network():
    """Windows through embedding and filters step by step give the folded result."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (40, B.WINDOW)).astype(np.uint8)
    model = B.train(x, np.arange(40) % 3, ("a", "b", "c"), steps=3)
    parts = np.split(model.table.reshape(256, 256, -1), [8, 16, 24, 32], axis=2)
    pair = lambda t, k, at: t[x[:, at], x[:, at + 1]][:, k]
    hidden = []
    for width, places in ((2, B.WINDOW - 1), (3, B.WINDOW - 3), (4, B.WINDOW - 3)):
        for k in range(B.FILTERS):
            z = []
            for at in range(places):
                value = pair(parts[width - 2], k, at)
                if width > 2:
                    value = value + pair(parts[width], k, at + 2)
                z.append(value)
            hidden.append(np.maximum(np.max(z, axis=0) + model.bias[(width - 2) * B.FILTERS + k], 0))
    logits = np.stack(hidden, axis=1) @ model.out + model.out_bias
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    assert np.allclose(model.windows(x), e / e.sum(axis=1, keepdims=True), atol=1e-5)


def test_held_out_accuracy(spark, docs):
    held_out = B.held_out_fold()
    found = B.identify(docs, B.learn_languages(docs, ~held_out), held_out).join(docs, "doc_id")
    right = F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))
    rows = {r["held_out"]: r["ok"] for r in found.groupBy("held_out").agg(right.alias("ok")).collect()}
    assert rows[True] > 0.95 and rows[False] > 0.97
    assert found.filter("score < 0 or score > 1").isEmpty()


def test_training_reads_only_usable_rows(spark):
    rows = [(i, "abcdefg " * 9 if i % 2 else "uvwxyz " * 9, "x" if i % 2 else "y") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert B.learn_languages(df, F.col("lang") == "x").languages == ("x",)
    model = B.learn_languages(df)
    assert model.predict(["abcdefg abc", "uvwxyz uv"])[0] == ["x", "y"]


def test_odd_documents(odd, none):
    model = B.learn_languages(odd)
    found = B.identify(odd, model, B.held_out_fold())
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == odd.count()
    und = {r["doc_id"] for r in found.filter("lang_pred = 'und' and score = 0").collect()}
    assert und == {3, 4, 5, 10, None}
    assert B.keep_identified(odd, model, 0.0).columns == odd.columns
    assert B.keep_identified(odd, model, 0.0).filter("doc_id in (3, 4, 5, 10)").isEmpty()
    nothing = B.learn_languages(none)
    assert B.identify(none, nothing).isEmpty()
    assert {r["lang_pred"] for r in B.identify(odd, nothing).collect()} == {"und"}


def test_all_of_many_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(B, "MAX_TEXTS", 600)
    rows = [(i, f"{chr(0x4E00 + i % 300) * 40} word", f"l{i % 300:03d}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taught = []
    monkeypatch.setattr(B, "train", lambda x, y, languages, **k: taught.append((x, y, languages)))
    for parts in (2, 7):
        B.learn_languages(df.repartition(parts))
    assert len(taught[0][2]) == 300 and len(taught[0][1]) <= 2 * 600 * B.WINDOWS_PER_TEXT
    assert taught[0][2] == taught[1][2] and (taught[0][0] == taught[1][0]).all()
    monkeypatch.setattr(B, "MAX_LANGUAGES", 299)
    with pytest.raises(ValueError):
        B.learn_languages(df)


def test_repeated_rows_do_not_multiply_the_sample(spark, monkeypatch):
    monkeypatch.setattr(B, "TEXTS_PER_LANGUAGE", 10)
    rows = [(1, "the same text again and again", "en")] * 300 + [(i, f"ein anderer Text {i}", "de") for i in range(2, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taught = []
    monkeypatch.setattr(B, "train", lambda x, y, languages, **k: taught.append((x, y)))
    for parts in (1, 5):
        B.learn_languages(df.repartition(parts))
    assert len(taught[0][1]) <= 2 * 10 * 2 * B.WINDOWS_PER_TEXT
    assert (taught[0][0] == taught[1][0]).all() and (taught[0][1] == taught[1][1]).all()
