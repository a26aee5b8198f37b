"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner
s-mers lies at its first or last place.  Whether it is one depends on its own
code points only, so an edit moves no anchor elsewhere, and two texts can be
matched by the positions of their common anchors.  A fingerprint keeps, for each
of BINS parts of the hash space, one byte of the smallest anchor hash in it; the
share of bins that agree estimates the likeness (Jaccard) of two texts' anchors.

Defined results: NULL is the empty text; an empty text has no anchor, and two
such texts are alike (1.0); a text shorter than a k-mer is its own anchor; NULL
ids come first in order; repeated ids follow each other in the order of their
texts' hashes; the last document is followed by the first, a single one by
itself; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.llm.common import mix64

K = 16
S = 5
BINS = 128
_SPAN = K - S  # places between the first and the last s-mer of a k-mer
_CHUNK = 1 << 18
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_EMPTY = 0  # the byte of a bin without anchor


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _roll(codes: np.ndarray) -> np.ndarray:
    """Hash of the s-mer at each place (before mixing)."""
    wide, n = codes.astype(np.uint64), len(codes) - S + 1
    h = wide[:n].copy()
    with np.errstate(over="ignore"):
        for k in range(1, S):
            h *= _ODD[0]
            h += wide[k : k + n]
    return mix64(h)


def _hash(codes: np.ndarray) -> int:
    """Hash of a short text as a whole."""
    h = int(len(codes)) + 1
    for c in codes.tolist():
        h = (h * int(_ODD[1]) + c) & ((1 << 64) - 1)
    return int(mix64(np.array([h], dtype=np.uint64))[0])


def anchors(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the closed syncmers of an array of code points."""
    places, hashes = [], []
    for at in range(0, max(0, len(codes) - K + 1), _CHUNK):
        h = _roll(codes[at : at + _CHUNK + K - 1])
        n = len(h) - _SPAN
        two = np.minimum(h[:-1], h[1:])
        four = np.minimum(two[:-2], two[2:])
        eight = np.minimum(four[:-4], four[4:])
        least = np.minimum(eight[:n], four[_SPAN - 3 : _SPAN - 3 + n])
        chosen = np.flatnonzero((h[:n] == least) | (h[_SPAN : _SPAN + n] == least))
        with np.errstate(over="ignore"):
            # Four s-mers cover all code points of the k-mer.
            whole = h[chosen] + _ODD[1] * h[chosen + S] + _ODD[2] * h[chosen + 2 * S] + _ODD[3] * h[chosen + _SPAN]
        places.append(chosen + at)
        hashes.append(mix64(whole))
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def common_anchors(a: str, b: str) -> np.ndarray:
    """Pairs of places (in a, in b) of anchors that are unique in both texts and common to them."""
    found = []
    for text in (a, b):
        place, value = anchors(code_points(text))
        distinct, first, count = np.unique(value, return_index=True, return_counts=True)
        found.append((distinct[count == 1], place[first[count == 1]]))
    _, i, j = np.intersect1d(found[0][0], found[1][0], return_indices=True)
    pairs = np.stack([found[0][1][i], found[1][1][j]], axis=1)
    return pairs[np.argsort(pairs[:, 0])]


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of BINS bytes per text."""
    prints = np.full((len(texts), BINS), _EMPTY, dtype=np.uint8)
    if not texts:
        return prints
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    codes = code_points("".join(texts))
    place, value = anchors(codes)
    owner = np.searchsorted(ends, place, side="right")
    inside = place + K <= ends[owner]
    owner, value = owner[inside], value[inside]
    short = np.flatnonzero((lengths > 0) & (lengths < K))
    if len(short):
        own = np.array([_hash(codes[ends[i] - lengths[i] : ends[i]]) for i in short], dtype=np.uint64)
        owner, value = np.concatenate([owner, short]), np.concatenate([value, own])
    if not len(owner):
        return prints
    bucket = owner.astype(np.int64) * BINS + (value & np.uint64(BINS - 1)).astype(np.int64)
    order = np.lexsort((value, bucket))
    bucket, value = bucket[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    prints.reshape(-1)[bucket[first]] = 1 + (value[first] >> np.uint64(20)) % np.uint64(255)
    return prints


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of the rows of two arrays of fingerprints."""
    some = ((a != _EMPTY) | (b != _EMPTY)).sum(axis=1)
    agree = ((a == b) & (a != _EMPTY)).sum(axis=1)
    share = agree / np.maximum(1, some)
    chance = 1 / 255  # of two bytes that agree by accident
    return np.where(agree == some, 1.0, np.clip((share - chance) / (1 - chance), 0.0, 1.0))


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# Spark ----------------------------------------------------------------------------


def with_followers(docs: DataFrame) -> DataFrame:
    """Rows (bucket, guest, doc_id, text) laid out so that each document is followed by the next one.

    Buckets are ranges of ids between percentiles, so they hold about equally
    many documents, and each ends with a guest: a copy of the document that
    starts the next bucket.  Texts are shuffled once; the driver sees one bound
    and one first id per bucket.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / buckets for k in range(1, buckets)]
    found = texts.agg(F.percentile_approx("doc_id", shares, 100 * buckets).alias("at")).first()["at"]
    bounds = np.unique(np.array(found or [], dtype=np.int64))

    @F.pandas_udf("int")
    def bucket_of(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna().to_numpy()
        place = np.searchsorted(bounds, doc_id.fillna(0).astype("int64").to_numpy(), side="right")
        return pd.Series(np.where(known, place, 0).astype("int32"))

    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first")
    heads = texts.select("doc_id", bucket_of("doc_id").alias("bucket")).groupBy("bucket").agg(first).orderBy("bucket").collect()
    firsts = [h["first"]["doc_id"] for h in heads]
    # The guest of each bucket is the head of the one behind it; the last one is followed by the first.
    host = {firsts[(k + 1) % len(firsts)]: heads[k]["bucket"] for k in range(len(heads))}
    named = [k for k in host if k is not None]
    hosts = F.create_map(*[F.lit(v) for k in named for v in (k, host[k])]) if named else None
    guests = texts.filter(F.col("doc_id").isin(named)).withColumn("bucket", hosts[F.col("doc_id")] if named else F.lit(0))
    if None in host:
        guests = guests.unionByName(texts.filter(F.col("doc_id").isNull()).withColumn("bucket", F.lit(host[None])))
    own = texts.withColumn("bucket", bucket_of("doc_id")).withColumn("guest", F.lit(0))
    rows = own.unionByName(guests.withColumn("guest", F.lit(1))).withColumn("text_hash", F.xxhash64("text"))
    order = ["bucket", "guest", F.asc_nulls_first("doc_id"), "text_hash"]
    laid = rows.repartition("bucket").sortWithinPartitions(*order)
    return laid.select("bucket", "guest", "doc_id", "text")


_RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document are."""
    fields = pa.schema(list(_RESULT.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                held += zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True)
                if len(held) > 1:
                    yield from compare(held)
                    held = held[-1:]

    def compare(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Results of all rows but the last; guests have none."""
        keep = [i for i in range(len(rows) - 1) if not rows[i][1]]
        if not keep:
            return
        texts = [r[3] for r in rows]
        changed = [edited(texts[i], texts[i + 1]) for i in keep]
        prints = fingerprints(texts)
        own, following, after = prints[keep], prints[[i + 1 for i in keep]], fingerprints(changed)
        columns = [
            [rows[i][2] for i in keep],
            [len(texts[i]) for i in keep],
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            [p.tobytes().hex() for p in own],
            [p.tobytes().hex() for p in after],
            likeness(own, after),
            likeness(own, following),
        ]
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string"
    return with_followers(docs).mapInArrow(run, schema + ", near_edited double, near_next double")
