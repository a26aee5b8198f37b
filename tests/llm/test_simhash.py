import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from assocframe.llm import simhash as S
from assocframe.llm.components import component_roots


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Smallest place reachable, by comparing all pairs."""
    x = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None]) <= 3
    root = np.arange(len(x))
    while True:
        new = np.array([root[row].min() for row in near])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def test_fingerprints(docs):
    texts = [r["text"] for r in docs.select("text").limit(60).collect()] + [None, "", "A", "É b", "a b c", "A B C d"]
    for text in texts:
        assert int.from_bytes(S.fingerprint(text), "big") == plain(text)
    long = " ".join(f"w{i}" for i in range(70_000))
    assert int.from_bytes(S.fingerprint(long), "big") == plain(long)


def near_numbers(rng, groups, size):
    found = set()
    for _ in range(groups):
        x = rng.getrandbits(64)
        for _ in range(size):
            found.add(x)
            for _ in range(rng.randrange(1, 6)):
                x ^= 1 << rng.randrange(64)
    return sorted(found)


@pytest.mark.parametrize("limit", [8_192, 40])
def test_links_lose_nothing(spark, monkeypatch, limit):
    """Also where segment values are crowded and cut into tiles."""
    monkeypatch.setattr(S, "LARGEST_BUCKET", limit)
    monkeypatch.setattr(S, "TILE", 32)
    rng = random.Random(4)
    fps = near_numbers(rng, 60, 12) + [rng.getrandbits(40) for _ in range(300)] + [0, 1, 3, 2**64 - 1]
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = S.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    got = dict(component_roots(edges).collect())
    root = brute_components(fps)
    members = {}
    for x, r in zip(signed, root, strict=True):
        members.setdefault(r, []).append(x)
    assert any(len(m) > 5 for m in members.values())
    for group in members.values():
        assert {got.get(x, x) for x in group} == {min(group)}


def test_tiles_with_larger_populations_are_skipped():
    fp = np.array([0, 2**8 - 1, 2**9 - 1], dtype=np.int64)
    pop = np.bitwise_count(fp.view(np.uint64)).astype(np.int64)
    found = [b.to_pylist() for b in S._compare_sorted(np.zeros(3, dtype=np.int64), pop, fp)]
    assert found == [[{"a": 511, "b": 255}]]
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["bucket", "pop", "fp"])
    assert list(S._compare(iter([empty]))) == []


def test_components_match_all_pairs(spark, docs):
    rows = sorted(S.near_duplicates(docs).collect(), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fps = [plain(texts[r["doc_id"]]) for r in rows]
    assert [r["fp"] % (1 << 64) for r in rows] == fps
    root = brute_components(fps)
    assert [r["component_id"] for r in rows] == [rows[k]["doc_id"] for k in root]


def test_long_chains(spark):
    path = [(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)]
    rows = component_roots(spark.createDataFrame(path, "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in rows} == {(i, 0) for i in range(301)} | {(1000, 1000), (1001, 1000)}


def test_odd_documents(odd, none):
    found = S.near_duplicates(odd)
    assert found.count() == odd.count()
    of = {}
    for r in found.collect():
        of.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert of[1] == of[2] and {c for _, c in of[1]} == {1}
    assert of[3] == of[4] == of[5] == {(0, 3)}
    assert of[8] == {(of[9] & of[8]).pop()}  # A-Z is lower-cased
    kept = S.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 10, 11] and ids.count(None) == 1
    assert S.near_duplicates(none).isEmpty() and S.keep_one_of_each(none).isEmpty()


def test_components_of_null_ids_keep_one(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x")], "doc_id long, text string")
    assert sorted(r["text"] for r in S.keep_one_of_each(df).collect()) == ["a b c d", "x"]
