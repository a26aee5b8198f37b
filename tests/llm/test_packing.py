import zlib

import numpy as np
import pytest

from assocframe.llm import packing as P
from assocframe.llm.encoding import encoder, vocabulary

WORDS = vocabulary("word_bpe_49k.json")


@pytest.mark.parametrize("rule", ["residual_norm", "dot_product"])
@pytest.mark.parametrize("caps", [P.Capacities(), P.Capacities(documents=5), P.Capacities(attention=4096 * 1500)])
def test_every_capacity_holds_and_bins_are_few(rule, caps):
    rng = np.random.default_rng(2)
    top = min(caps.tokens, int(caps.attention**0.5))
    lengths = np.clip(rng.lognormal(5.5, 1.2, 600).astype(int), 1, top)
    where, offset = P.best_fit(lengths, caps, rule)
    for s in np.unique(where):
        own = np.flatnonzero(where == s)
        own = own[np.argsort(offset[own])]
        assert lengths[own].sum() <= caps.tokens and len(own) <= caps.documents
        assert (lengths[own] ** 2).sum() <= caps.attention
        assert offset[own].tolist() == [0, *np.cumsum(lengths[own])[:-1].tolist()]
    least = max(lengths.sum() / caps.tokens, len(lengths) / caps.documents, (lengths**2).sum() / caps.attention)
    assert where.max() + 1 <= 1.25 * least + 1


def check_pack(docs, rows, caps):
    want = {}
    for r in docs.collect():
        data = encoder(WORDS).encode(r["text"]) + np.array([1], "<u4").tobytes()
        for k, at in enumerate(range(0, len(data), 4 * caps.tokens)):
            part = data[at : at + 4 * caps.tokens]
            key = (r["doc_id"], k, at // 4, len(part) // 4, zlib.crc32(part))
            want[key] = want.get(key, 0) + 1
    got, sequences = {}, {}
    for r in rows:
        key = (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
        got[key] = got.get(key, 0) + 1
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= caps.tokens
    return len(sequences), sum(r["length"] for r in rows)


def test_whole_table(docs):
    caps = P.Capacities()
    used, tokens = check_pack(docs, P.pack(P.pieces(docs, WORDS)).collect(), caps)
    assert used <= tokens / caps.tokens * 1.01 + 1


def test_many_blocks(docs):
    caps = P.Capacities(tokens=512, attention=512 * 512)
    rows = P.pack(P.pieces(docs, WORDS, caps), caps, block=16).collect()
    assert len({r["sequence_id"] >> 32 for r in rows}) > 4
    check_pack(docs, rows, caps)


def test_ids_and_other_columns_stay(docs):
    cut = P.pieces(docs.limit(20), WORDS, ids=True)
    for r in P.pack(cut).collect():
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]


def test_odd_documents(odd, none):
    check_pack(odd, P.pack(P.pieces(odd, WORDS)).collect(), P.Capacities())
    assert P.pack(P.pieces(none, WORDS)).isEmpty()
