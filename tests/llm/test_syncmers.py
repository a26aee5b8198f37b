import hashlib

import numpy as np

from assocframe.llm import syncmers as S


def plain_anchors(text):
    codes = S.code_points(text)
    if len(codes) < S.K:
        return []
    h = S._roll(codes).tolist()
    found = []
    for i in range(len(codes) - S.K + 1):
        inner = h[i : i + S.K - S.S + 1]
        if min(inner) in (inner[0], inner[-1]):
            found.append(i)
    return found


def test_anchors_are_closed_syncmers(docs, monkeypatch):
    texts = [r["text"] for r in docs.select("text").limit(40).collect()] + ["a" * 100, "ab" * 30, "é" * 16, "short"]
    for text in texts:
        assert S.anchors(S.code_points(text))[0].tolist() == plain_anchors(text)
    monkeypatch.setattr(S, "_CHUNK", 50)
    for text in texts[:10]:
        assert S.anchors(S.code_points(text))[0].tolist() == plain_anchors(text)


def test_anchors_are_free_of_context():
    text = "the anchors of a passage do not depend on what stands around it, before or after, at all"
    place, value = S.anchors(S.code_points(text))
    moved, again = S.anchors(S.code_points("ééé 12 " + text + " and more"))
    inner = {(p - 7, v) for p, v in zip(moved.tolist(), again.tolist(), strict=True)}
    assert {*zip(place.tolist(), value.tolist(), strict=True)} <= inner
    pairs = S.common_anchors(text, "xyz" + text)
    assert len(pairs) and (pairs[:, 1] - pairs[:, 0] == 3).all()


def test_batches_do_not_mix_texts(docs):
    texts = [r["text"] for r in docs.select("text").limit(50).collect()] + ["", "a", "", "short text"]
    both = S.fingerprints(texts)
    for text, row in zip(texts, both, strict=True):
        assert (S.fingerprints([text])[0] == row).all()
    assert (S.likeness(both, both) == 1).all()


def test_likeness_estimates_shared_anchors(docs):
    texts = [r["text"] for r in docs.select("text").collect() if len(r["text"]) > 2000][:40]
    changed = [S.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1], strict=True)]
    own = [set(S.anchors(S.code_points(t))[1].tolist()) for t in texts]
    new = [set(S.anchors(S.code_points(t))[1].tolist()) for t in changed]
    true = np.array([len(a & b) / len(a | b) for a, b in zip(own, new, strict=True)])
    found = S.likeness(S.fingerprints(texts), S.fingerprints(changed))
    assert np.abs(found - true).mean() < 0.06


def check(df):
    given = sorted(
        ((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0)
    )
    got = sorted(S.edited_likeness(df).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert [(r["doc_id"], r["n_chars"]) for r in got] == [(d, len(t)) for d, t in given]
    for k, r in enumerate(got):
        text, following = given[k][1], given[(k + 1) % len(given)][1]
        n = len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints = S.fingerprints([text, edited, following])
        assert [r["fingerprint"], r["edited_fingerprint"]] == [p.tobytes().hex() for p in prints[:2]]
        assert r["near_edited"] == S.likeness(prints[:1], prints[1:2])[0]
        assert r["near_next"] == S.likeness(prints[:1], prints[2:])[0]


def test_next_documents_over_all_buckets(docs):
    check(docs.select("doc_id", "text").repartition(7))


def test_few_documents(spark):
    for n in (1, 2, 3):
        check(spark.createDataFrame([(7 * i, f"text number {i} " * 9) for i in range(n)], "doc_id long, text string"))


def test_odd_documents(spark, odd, none):
    rows = S.edited_likeness(odd).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r["doc_id"] in (3, 4)]
    assert {r["near_edited"] for r in empty} == {1.0} and {r["n_chars"] for r in empty} == {0}
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (1, 2)} == {rows[[r["doc_id"] for r in rows].index(1)]["fingerprint"]}
    distinct = odd.filter("doc_id is null or doc_id <> 2").filter("doc_id is not null or text is not null")
    check(distinct)
    assert S.edited_likeness(none).isEmpty()
