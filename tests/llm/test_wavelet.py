import zlib

import numpy as np
import pytest

from assocframe.llm import wavelet as W
from assocframe.llm.encoding import encoder, vocabulary

BYTES = vocabulary("byte_bpe_50k.json")


@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (511, 7), (512, 300), (513, 50257), (9000, 50257), (900, 1 << 30)])
def test_queries_match_the_plain_array(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype("<u4")
    shard = W.Shard(np.frombuffer(W.shard_bytes([5], [n], ids), dtype=np.uint8))
    m = shard.matrix
    assert shard.doc_ids == [5] and shard.starts.tolist() == [0, n]
    assert (m.decode() == ids).all()
    at = rng.integers(0, n, 100) if n else np.zeros(0, dtype=int)
    assert (m.access(at) == ids[at]).all()
    for token in {*ids[:20].tolist(), 12345678}:
        places = np.flatnonzero(ids == token)
        assert (m.occurrences(token) == places).all()
        assert m.count(token, n // 3, n // 2) == (ids[n // 3 : n // 2] == token).sum()
        assert m.rank(token, n // 2) == (places < n // 2).sum()
        with pytest.raises(IndexError):
            m.select(token, np.array([len(places)]))


def test_a_plane_takes_a_bit_a_token():
    ids = np.random.default_rng(1).integers(0, 1000, 200_000).astype("<u4")
    assert 10 < len(W.shard_bytes([1], [len(ids)], ids)) * 8 / len(ids) < 11.2


def plain(docs):
    order = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    out, start = [], 0
    for r in order:
        data = encoder(BYTES).encode(r["text"]) + np.array([2], "<u4").tobytes()
        out.append((r["doc_id"], start, len(data) // 4, zlib.crc32(data)))
        start += len(data) // 4
    return out


def run(docs, spark):
    folder, manifest = W.write_shards(docs, BYTES)
    rows = W.with_starts(W.read_shards(spark, folder), manifest).collect()
    return folder, manifest, sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)


def test_round_trip_in_many_files(spark, docs, monkeypatch):
    monkeypatch.setattr(W, "SHARD_TOKENS", 5_000)
    folder, manifest, rows = run(docs.repartition(5), spark)
    assert [(d, s, n, c) for s, d, n, c in rows] == plain(docs)
    names = [r["name"] for r in manifest.orderBy("part", "shard").collect()]
    assert len(names) > 10
    shard = W.Shard.open(f"{folder}/{names[0]}")
    assert shard.matrix.count(2) == len(shard.doc_ids)  # every document ends once
    assert (shard.matrix.occurrences(2) == shard.starts[1:] - 1).all()


def test_odd_documents(spark, odd, none):
    _, _, rows = run(odd, spark)
    starts = [s for s, *_ in rows]
    assert starts == [0, *np.cumsum([n for _, _, n, _ in rows])[:-1].tolist()]
    ids = [d for _, d, _, _ in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    want = sorted((n, c) for _, _, n, c in plain(odd))
    assert sorted((n, c) for _, _, n, c in rows) == want
    assert run(none, spark)[2] == []
    with pytest.raises(ValueError):
        W.Shard(np.zeros(64, dtype=np.uint8))
