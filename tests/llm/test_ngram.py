import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assocframe.llm import ngram as N
from assocframe.llm.common import fold_of
from assocframe.llm.eliasfano import EliasFano


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 3), (1000, 10), (1000, 1 << 20), (5000, 1 << 63), (3000, 3000)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    data = np.frombuffer(EliasFano.build(values).to_bytes(), dtype=np.uint8)
    sequence, end = EliasFano.read(data, 0)
    assert end == len(data) and (sequence.access(np.arange(n)) == values).all()
    first = {}
    for i, v in enumerate(values.tolist()):
        first.setdefault(v, i)
    asked = np.concatenate([values, rng.integers(0, top, 300, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    assert sequence.find(asked).tolist() == [first.get(v, -1) for v in asked.tolist()]


def test_elias_fano_is_small():
    values = np.sort(np.random.default_rng(0).integers(0, 1 << 40, 1 << 16, dtype=np.uint64))
    assert len(EliasFano.build(values).to_bytes()) * 8 / len(values) < (40 - 16) + 6


class Plain:
    """The same model in dictionaries, without quantising."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for text in texts:
            tokens = [N.END, *self.tokens(text)]
            self.counts[1].update(tokens[1:])
            for n in range(2, order + 1):
                self.counts[n].update(zip(*(tokens[k:] for k in range(n)), strict=False))
        self.total, self.words = sum(self.counts[1].values()), len(self.counts[1])
        self.counts[1] = {(w,): c for w, c in self.counts[1].items()}
        self.given = [defaultdict(float) for _ in range(order + 1)]
        for n in range(2, order + 1):
            self.counts[n] = {k: c for k, c in self.counts[n].items() if c >= N.MIN_COUNT}
            for k, c in self.counts[n].items():
                self.given[n][k[:-1]] += (c - N.DISCOUNT) / self.counts[n - 1][k[:-1]]

    @staticmethod
    def tokens(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*lower.encode().split(), N.END]

    def score(self, text):
        tokens, base, score = [N.END, *self.tokens(text)], 0.0, 0.0
        for i in range(1, len(tokens)):
            p = (self.counts[1].get((tokens[i],), 0) + 1) / (self.total + self.words + 1)
            base += math.log10(p)
            for n in range(2, min(self.order, i + 1) + 1):
                gram = tuple(tokens[i - n + 1 : i + 1])
                if gram[:-1] in self.counts[n - 1]:
                    p *= 1 - self.given[n][gram[:-1]]
                    if gram in self.counts[n]:
                        p += (self.counts[n][gram] - N.DISCOUNT) / self.counts[n - 1][gram[:-1]]
            score += math.log10(min(p, 1.0))
        known = sum((t,) in self.counts[1] for t in tokens[1:])
        return len(tokens) - 1, known, base, score


def check(docs, order):
    held_out = fold_of("doc_id", 7) == 2
    model = N.train(docs.filter(~held_out).select("text"), order)
    rows = N.score_documents(docs, model, held_out).withColumn("key", F.col("doc_id")).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    marked = dict(docs.select("doc_id", held_out).distinct().collect())
    plain = Plain([t for d, t in texts if not marked[d]], order)
    assert (model.tokens, model.words) == (plain.total, plain.words)
    assert [int(level.starts[-1]) for level in model.levels] == [len(c) for c in plain.counts[1 : len(model.levels) + 1]]
    want = defaultdict(list)
    for d, t in texts:
        want[d].append(plain.score(t))
    got = defaultdict(list)
    for r in rows:
        assert r["held_out"] == marked[r["doc_id"]] and r["train_tokens"] == plain.total
        got[r["doc_id"]].append((r["n_tokens"], r["n_known"], r["base_score"], r["score"]))
    assert got.keys() == want.keys()
    for d in want:
        for g, w in zip(sorted(got[d]), sorted(want[d]), strict=True):
            assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-9)
            assert abs(g[3] - w[3]) <= 0.03 * w[0]  # a quantised probability is within some percent
    return rows


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_match_the_plain_model(docs, order):
    rows = check(docs, order)
    if order > 1:  # the model knows more than the base on texts it has not seen
        held = [r for r in rows if r["held_out"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_frequent_contexts_are_cut_into_word_ranges(docs, monkeypatch):
    monkeypatch.setattr(N, "WORD_RANGE", 50)
    monkeypatch.setattr(N, "HELD", 500)
    monkeypatch.setattr(N, "CHARS_AT_ONCE", 3_000)
    check(docs.limit(60), 3)


def test_odd_documents(odd, none):
    check(odd, 3)
    check(none, 3)
    model = N.train(none.select("text"))
    assert N.score_documents(odd, model, F.lit(False)).count() == odd.count()


@pytest.mark.parametrize("spread", [1, 7, 10**6, 2**40])
def test_elias_fano_against_plain_numbers(spread):
    """Crowded and empty buckets, long runs of ones and zeros, numbers that repeat, numbers that are missing."""
    rng = np.random.default_rng(spread % 1000)
    clumps = np.concatenate([rng.integers(0, 900, 700) + k * spread for k in rng.integers(0, 50, 6)])
    values = np.sort(np.concatenate([clumps, rng.integers(0, 40 * spread + 1, 500)])).astype(np.uint64)
    sequence, _ = EliasFano.read(np.frombuffer(EliasFano.build(values).to_bytes(), np.uint8), 0)
    places = rng.permutation(len(values))
    assert np.array_equal(sequence.access(places), values[places])
    one, two = sequence.access_two(places[places < len(values) - 1])
    assert np.array_equal(one, values[places[places < len(values) - 1]])
    assert np.array_equal(two, values[places[places < len(values) - 1] + 1])
    asked = np.concatenate([values, values + np.uint64(1), rng.integers(0, 60 * spread + 2000, 2000).astype(np.uint64)])
    first = np.searchsorted(values, asked)
    want = np.where(values[np.minimum(first, len(values) - 1)] == asked, first, -1)
    assert np.array_equal(sequence.find(asked), np.where(first < len(values), want, -1))


def test_tokens_are_words_between_ascii_white_space():
    """All six marks, at the ends and in a row; other spaces and controls belong to words; parts of longer arrays."""
    import pyarrow as pa
    import xxhash

    texts = ["  A b\t\n\x0b\x0c\r a ", None, "", " \n", "É\xa0X\u2003y\x1cZ\x85 \ufeff\U0001f600", "a"]
    tokens = N.Tokens(pa.array(["lost", *texts, "lost"]).slice(1, len(texts)))
    want = [[*("" if t is None else t).encode().lower().split(), N.END] for t in texts]
    assert tokens.sizes.tolist() == [len(w) for w in want]
    assert tokens.hashes[tokens.places].tolist() == [xxhash.xxh64_intdigest(w) for t in want for w in t]
    assert len(set(tokens.hashes.tolist())) == len(tokens.hashes) == len({w for t in want for w in t})
    assert len(N.Tokens(pa.array([], pa.string())).places) == 0


def test_words_are_hashed_together(monkeypatch):
    """Words of all lengths, the last at the end of the bytes; only long ones are hashed one by one."""
    import pyarrow as pa
    import xxhash

    words = ["w" * n + chr(n) + "é" * (n % 3) for n in range(1, 60) if not chr(n).isspace()]
    want = [xxhash.xxh64_intdigest(w) for w in [*map(str.encode, words), N.END]]
    alone, plain = [], xxhash.xxh64_intdigest
    monkeypatch.setattr(N.xxhash, "xxh64_intdigest", lambda w: alone.append(len(w)) or plain(w))
    tokens = N.Tokens(pa.array([" ".join(words)]))
    assert tokens.hashes[tokens.places].tolist() == want
    assert alone and min(alone) >= 32


@pytest.mark.parametrize("bits, counts", [((4, 3), 1), ((4, 3), 9), ((31, 33), 1), ((31, 33), 1 << 40), ((40, 30), 5)])
def test_pairs_are_summed_whatever_their_bits(bits, counts):
    rng = np.random.default_rng(3)
    c, w = (rng.integers(0, 1 << b, 50)[rng.integers(0, 50, 3000)] for b in bits)
    n = rng.integers(1, counts + 1, len(c))
    want = Counter()
    for key, more in zip(zip(c.tolist(), w.tolist()), n.tolist()):
        want[key] += more
    context, word, count = N.add_up(c, w, n)
    assert list(zip(zip(context.tolist(), word.tolist()), count.tolist())) == sorted(want.items())


@pytest.mark.parametrize("bits", [1, 20, 50, 64])
def test_places_sort_numbers_that_differ_in_the_lowest_bits_only(bits):
    rng = np.random.default_rng(5)
    for key in (rng.integers(0, 2, 5000), rng.integers(0, 1 << min(bits, 62), 5000), np.zeros(0, dtype=int), np.zeros(1, dtype=int)):
        key = (key % (1 << min(bits, 62))).astype(np.uint64)
        order = N.order_of(key, bits)
        assert np.array_equal(np.sort(order), np.arange(len(key))) and np.array_equal(key[order], np.sort(key))


def test_work_in_a_shard_does_not_look_at_other_rows():
    """Rows are dealt to shards by one sort, in their order."""
    shard = np.random.default_rng(1).integers(0, 70_000, 3000)
    dealt = list(N._by_shard(shard))
    assert [s for s, _ in dealt] == sorted(set(shard.tolist()))
    assert all(rows.tolist() == np.flatnonzero(shard == s).tolist() for s, rows in dealt)
    assert list(N._by_shard(shard[:0])) == []
