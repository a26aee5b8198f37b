from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from assocframe.llm import mixing as M


def plain_targets(sizes, weights=(5, 2, 1), factor=3):
    """Share by weight, stop at the cap, share the excess again: the rule word by word."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total = sum(sizes.values())
    stopped = {}
    while True:
        rest = [s for s in order if s not in stopped]
        left = total - sum(stopped.values())
        share = {s: Fraction(left * weight[s], sum(weight[r] for r in rest)) for s in rest} if rest else {}
        above = [s for s in rest if share[s] > factor * sizes[s]]
        if not above:
            return {**share, **stopped}
        stopped |= {s: factor * sizes[s] for s in above}


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 50, "d": 3, None: 700},
        {"a": 0, "b": 10, "": 5},
        {"é": 7, "z": 900, "Z": 30, "aa": 2, "ab": 4, "ac": 400, None: 1},
        {"a": 0},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in M.targets(rows).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(float(want[s]), abs=1e-6), s


def mixed(docs):
    sized = M.sizes(docs)
    return M.mix(sized, M.decisions(sized))


def test_rounding_keeps_each_source_near_its_target(docs):
    rows = mixed(docs.select("doc_id", "text", (F.col("doc_id") % 3).cast("string").alias("source"))).collect()
    assert len(rows) == docs.count()
    taken, size, largest = Counter(), Counter(), defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["copies"] * r["size"]
        size[r["source"]] += r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["copies"] in (int(r["target"] // r["source_size"]), int(r["target"] // r["source_size"]) + 1)
    want = plain_targets(dict(size))
    for r in rows:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]))
    for s in size:
        assert abs(taken[s] - float(want[s])) <= largest[s] / 2 + 1e-6


def test_every_document_has_its_expected_chance(spark):
    # 4,000 documents of one size in one of three sources: the share taken twice is the fraction of the ratio.
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.lit(10)).alias("text"),
        F.when(F.col("id") < 4000, "a").when(F.col("id") < 5000, "b").otherwise("c").alias("source"),
    )
    rows = mixed(docs).filter("source = 'b'").collect()
    want = plain_targets({"a": 40_000, "b": 10_000, "c": 10_000})["b"] / 10_000
    copies = Counter(r["copies"] for r in rows)
    assert set(copies) <= {1, 2} and copies[2] == round(float(want - 1) * 1000)
    halves = [sum(r["copies"] for r in rows if r["doc_id"] % 2 == k) for k in (0, 1)]
    assert abs(halves[0] - halves[1]) < 120  # no side is favoured


def test_reruns_agree_whatever_the_partitions(docs):
    source = docs.select("doc_id", "text", (F.col("doc_id") % 2).cast("string").alias("source"))
    both = [
        sorted((r["doc_id"], r["copies"]) for r in mixed(source.repartition(n)).collect()) for n in (1, 7)
    ]
    assert both[0] == both[1]


def test_odd_documents(odd, none):
    rows = mixed(odd).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["copies"] <= 3 for r in rows)
    repeats = [r["copies"] for r in rows if r["doc_id"] == 2]
    assert max(repeats) - min(repeats) <= 1
    taken = M.take_mixed(odd)
    assert taken.columns == odd.columns
    assert taken.count() == sum(r["copies"] for r in rows)
    assert mixed(none).isEmpty() and M.take_mixed(none).isEmpty()


def test_no_python_in_the_plan(docs):
    plan = mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("piece", [4096, 7])
def test_repeated_rows_keep_their_source_near_its_target(spark, monkeypatch, piece):
    """A source made mostly of one row: its repeats are taken one by one, not all or none."""
    monkeypatch.setattr(M, "_PIECE", piece)
    rows = [(k, "w " * (20 + 13 * k % 400), "abc"[k % 3], k) for k in range(30)]
    rows += [(1000, "v " * 600, "b", 0)] * 40  # equal in all columns
    rows += [(1001, "u " * 500, "b", k % 9) for k in range(25)] + [(None, "n " * 90, "c", k) for k in range(31)]
    rows += [(1002, "long " * 9000, "a", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int").repartition(5)
    found = mixed(docs).collect()
    assert Counter((r["doc_id"], r["source"]) for r in found) == Counter((r[0], r[2]) for r in rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    want = plain_targets(dict(sizes))
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= largest[s] / 2 + 1e-6, s
    kept = M.take_mixed(docs)
    assert kept.columns == docs.columns
    lists = [sorted(map(tuple, df.collect()), key=repr) for df in (kept, M.take_mixed(docs.repartition(3)))]
    assert lists[0] == lists[1]
    by_key = Counter()
    for r in found:
        by_key[(r["doc_id"], r["source"])] += r["copies"]
    assert Counter((r[0], r[2]) for r in lists[0]) == +by_key
    # No row is taken oftener than its repeats allow.
    repeats = Counter(rows)
    assert all(n <= 3 * repeats[r] for r, n in Counter(lists[0]).items())
