"""Graph search against brute force: scores and order exact, recall at least 0.9."""

import numpy as np
import pytest

from assocframe.llm import hnsw
from assocframe.llm.queries import QUERIES


def brute(rows, asked, k):
    """query_id -> [(score, vec_id)] over distinct (id, vector) rows that take part."""
    good = {(i, tuple(v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for own in good:
        if own[0] is None or not asked(own[0]):
            continue
        found = []
        for other in good:
            if other != own and len(other[1]) == len(own[1]):
                gap = np.sqrt(((np.array(other[1]) - np.array(own[1])) ** 2).sum())
                found.append((gap, other[0] is None, other[0] or 0, other[0]))
        out[own] = [(g, i) for g, _, _, i in sorted(found)[:k]]
    return out


def rows_of(df):
    return [(r["vec_id"], r["embedding"]) for r in df.select("vec_id", "embedding").collect()]


def by_query(found):
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def recall(found, rows, asked, k=10):
    true, got = brute(rows, asked, k), by_query(found)
    scores = {(i, tuple(v)) for i, v in rows if v}
    vectors = dict(scores)
    hits = total = 0
    assert set(got) == {own[0] for own in true}
    for own, best in true.items():
        mine = got[own[0]]
        assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
        order = [(s, i) for _, i, s in mine]
        assert order == sorted(order)
        for _, i, s in mine:
            assert s == pytest.approx(np.sqrt(((np.array(vectors[i]) - np.array(own[1])) ** 2).sum()), rel=1e-12)
        hits += len({i for _, i, _ in mine} & {i for _, i in best})
        total += len(best)
    return hits / total


def test_query(spark, small):
    rows = rows_of(spark.read.parquet(f"{small}/embeddings.parquet"))
    found = QUERIES["op12_nearest_neighbours"](spark, small)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert recall(found, rows, lambda i: i % 100 == 0) >= 0.95


def test_recall_over_shards(spark):
    draw = np.random.default_rng(3)
    middles = draw.normal(size=(8, 24))
    points = [(i, [float(x) for x in middles[i % 8] + 0.3 * draw.normal(size=24)]) for i in range(6_000)]
    df = spark.createDataFrame(points, "vec_id long, embedding array<double>").repartition(5)
    rows = hnsw.usable(df)
    asked = rows.filter("vec_id % 150 = 0")
    assert asked.count() == 40
    found = hnsw.nearest(rows, df["vec_id"] % 150 == 0, 10, shard_rows=2_500)
    assert recall(found, points, lambda i: i % 150 == 0) >= 0.95


def test_graph_leads_everywhere():
    points = np.random.default_rng(1).normal(size=(5_000, 16)).astype(np.float32)
    order, graph = hnsw.build(points)
    assert sorted(order) == list(range(5_000)) and [x.shape[1] for x in graph] == [32] + [16] * (len(graph) - 1)
    found = hnsw.search(points[order], graph, points[order], 32)
    assert (found[:, 0] == np.arange(5_000)).mean() > 0.999  # each node is met from the entry
    again = hnsw.build(points)
    assert all((a == b).all() for a, b in zip(graph, again[1]))


ODD = [
    (0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]),
    (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (200, [1.0, 2.0, 3.0]), (8, [1.0, 2.0, 4.0]),
    (None, [1.0, 0.0]), (None, [3.0, 3.0]), (9, [-1.0, -0.0]), (300, [1e200, 1.0]), (10, [1e-200, 0.0]), (400, [7.0]),
]


def test_odd_vectors(spark):
    clash = ["dim", "shard", "ids", "path", "query", "vector", "scale", "block"]
    df = spark.createDataFrame([(i, v, *["z"] * 8) for i, v in ODD], "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` string" for c in clash))
    got = by_query(hnsw.nearest(hnsw.usable(df.repartition(3)), df["vec_id"] % 100 == 0, 10))
    want = brute(ODD, lambda i: i % 100 == 0, 10)
    assert got.keys() == {0, 100, 200, 300}  # 400 has no candidate
    for own, best in want.items():
        assert [(i, s) for _, i, s in got.get(own[0], [])] == [(i, pytest.approx(g, rel=1e-12)) for g, i in best]


def test_frequent_vector(spark):
    copies = [(i, [1.0, 1.0, 0.5]) for i in range(3_000)]
    others = [(10_000 + i, [float(i), 1.0, 0.0]) for i in range(200)]
    df = spark.createDataFrame(copies + others, "vec_id long, embedding array<float>").repartition(6)
    got = by_query(hnsw.nearest(hnsw.usable(df), df["vec_id"].isin(0, 5, 2_000, 10_003), 10))
    assert [i for _, i, _ in got[2_000]] == list(range(10))
    assert [i for _, i, _ in got[5]] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert got[0][0] == (1, 1, 0.0)
    assert [i for _, i, _ in got[10_003]] == [10_002, 10_004, *[i for i in (10_001, 10_005)]] + [i for _, i, _ in got[10_003]][4:]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hnsw.nearest(hnsw.usable(df), df["vec_id"] % 100 == 0).isEmpty()


def test_files_come_back_as_written():
    arrays = {"a": np.arange(7, dtype=np.int32), "b": np.zeros((0, 3), dtype=np.float32), "c": np.arange(6.0).reshape(2, 3)}
    back = hnsw.unpack(np.frombuffer(hnsw.pack(arrays), dtype=np.uint8))
    assert all((back[k] == v).all() and back[k].dtype == v.dtype for k, v in arrays.items())
