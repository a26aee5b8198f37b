"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are compared in tiles: numpy exclusive-ors two tiles of
fingerprints and counts bits.  Tiles are sorted by population count, and a tile
pair whose counts differ by more than the radius is skipped.

Not every tile meets every other one: two fingerprints that differ in at most
three bits agree in one of four 16-bit segments, so only fingerprints that share
a segment are laid out in common tiles.  This loses no link and keeps the work
from growing with the square of the table.  A segment value shared by very many
fingerprints is cut into tiles by population count first, and only tile pairs
within the radius are shipped to a task.  Tasks return the links as spanning
forests, never as all pairs.

Defined results: a NULL or blank text has fingerprint zero and is linked like any
other; NULL ids count as larger than all others, so a component has a NULL id
only if all its ids are NULL; repeated rows share fingerprint and component; an
empty table gives an empty result.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assocframe.llm.common import lower_words_of, map_rows
from assocframe.llm.components import component_roots
from assocframe.plans.materialize import materialize

RADIUS = 3
SEGMENTS = RADIUS + 1
SEGMENT_BITS = 64 // SEGMENTS
SEED = 42
TILE = 512
#: Segment values with more fingerprints are cut into tiles of about half as many before they are shipped.
LARGEST_BUCKET = 8_192
_CHUNK = 1 << 16


def fingerprint(text: str | None) -> bytes:
    """Eight bytes, most significant first: the majority of the bits of the 3-word shingles' hashes."""
    words = lower_words_of(text)
    if not words:
        return bytes(8)
    digest = xxhash.xxh64_digest
    if len(words) < 3:
        return digest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[at : at + _CHUNK], axis=1).sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed 64-bit number) of every document."""

    def run(rows: list[dict]) -> dict[str, list]:
        prints = [int.from_bytes(fingerprint(r["text"]), "big", signed=True) for r in rows]
        return {"doc_id": [r["doc_id"] for r in rows], "text_hash": [r["text_hash"] for r in rows], "fp": prints}

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_rows(texts, run, f"doc_id {kind}, text_hash bigint, fp bigint")


def links(prints: DataFrame) -> DataFrame:
    """A spanning forest ``(a, b)`` of all pairs of distinct ``fp`` that differ in at most RADIUS bits."""
    segments = [
        F.struct(F.lit(k).alias("segment"), F.shiftrightunsigned("fp", k * SEGMENT_BITS).bitwiseAND((1 << SEGMENT_BITS) - 1).alias("bits"))
        for k in range(SEGMENTS)
    ]
    pop = F.bit_count("fp").alias("pop")
    rows = prints.select("fp", pop, F.inline(F.array(*segments)))
    key = ["segment", "bits"]
    sizes = rows.groupBy(*key, "pop").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*key))
    half = LARGEST_BUCKET // 2
    # One row per population count (at most 65) of a crowded segment value, and the tiles it is cut into.
    crowded = materialize(
        sizes.withColumn("total", total)
        .filter(F.col("total") > LARGEST_BUCKET)
        .select(*key, "pop", F.ceil(F.col("n") / half).cast("int").alias("parts"))
    )
    plain = rows.join(crowded.select(*key).distinct(), key, "left_anti").withColumn("tiles", F.lit(0).cast("bigint"))
    tiles = crowded.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    one = tiles.select(*key, "pop", "part", (F.col("pop") * 100_000 + F.col("part")).alias("t"))
    other = one.select(*key, F.col("pop").alias("pop2"), F.col("t").alias("t2"))
    near = one.join(other, key).filter(F.abs(F.col("pop") - F.col("pop2")) <= RADIUS)
    pairs = near.select(*key, "pop", "part", F.xxhash64(F.least("t", "t2"), F.greatest("t", "t2")).alias("tiles"))
    cut = rows.join(crowded, [*key, "pop"]).withColumn("part", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
    shipped = cut.join(pairs, [*key, "pop", "part"]).select(*rows.columns, "tiles")
    laid = plain.unionByName(shipped)
    bucket = F.xxhash64("segment", "bits", "tiles").alias("bucket")
    return (
        laid.select(bucket, "pop", "fp")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "pop", "fp")
        .mapInArrow(_compare, "a bigint, b bigint")
        .distinct()
    )


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows sorted by bucket and population count; buckets are cut nowhere."""
    held = [np.zeros(0, dtype=np.int64) for _ in range(3)]
    for batch in batches:
        new = [batch.column(k).to_numpy().astype(np.int64, copy=False) for k in range(3)]
        held = [np.concatenate(x) for x in zip(held, new, strict=True)]
        whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        if whole:
            yield from _compare_sorted(*(x[:whole] for x in held))
            held = [x[whole:] for x in held]
    if len(held[0]):
        yield from _compare_sorted(*held)


def _compare_sorted(bucket: np.ndarray, pop: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
    bits = fp.view(np.uint64)
    for at in range(0, len(fp), TILE):
        end = min(at + TILE, len(fp))
        to = at
        while to < len(fp):
            stop = min(to + TILE, len(fp))
            if to > at:
                # A later tile matters as long as it goes on with the tile's last bucket, within the radius.
                if bucket[to] != bucket[end - 1]:
                    break
                if pop[to] - pop[end - 1] > RADIUS:
                    break
            near = np.bitwise_count(bits[at:end, None] ^ bits[None, to:stop]) <= RADIUS
            i, j = np.nonzero(np.triu(near, 1) if to == at else near)
            if len(i):
                yield _forest(fp, i + at, j + to)
            to = stop


def _forest(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """As many links as join the same fingerprints: each one with the first of its group."""
    nodes, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = at[: len(i)], at[len(i) :]
    first = np.arange(len(nodes))
    while True:
        new = first.copy()
        np.minimum.at(new, a, first[b])
        np.minimum.at(new, b, first[a])
        new = new[new]
        if (new == first).all():
            break
        first = new
    moved = first != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays([pa.array(fp[nodes[moved]]), pa.array(fp[nodes[first[moved]]])], schema=_EDGES)


def components(prints: DataFrame) -> DataFrame:
    """fp, root and component_id of every distinct fingerprint of ``fingerprints``.

    The root is the smallest fingerprint reachable, the id the smallest doc_id.
    The result is written to the checkpoint folder, so a join with it has
    partitions of its own, which Spark can split where one fingerprint is frequent.
    """
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = component_roots(links(distinct.select("fp")))
    linked = roots.join(distinct, roots.node == distinct.fp).select("fp", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    named = linked.join(least, "root").select("fp", "root", "component")
    labels = distinct.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "first").alias("component_id")
    )
    return materialize(labels)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, root and component_id of every document."""
    prints = materialize(fingerprints(docs))
    found = prints.join(components(prints), "fp", "left")
    return found.select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one of the smallest id, then text hash.

    Repeated rows of that document count as one.
    """
    prints = materialize(fingerprints(docs))
    return keep_smallest(docs, prints, components(prints))


def keep_smallest(docs: DataFrame, prints: DataFrame, labels: DataFrame) -> DataFrame:
    """One document of each ``root`` in ``labels(fp, root)``; ``prints`` has doc_id, text_hash and fp of every document."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    # The smallest of a fingerprint is found before any join, so copies never gather.
    own = prints.groupBy("fp").agg(F.min(order).alias("_own"))
    best = own.join(labels, "fp").groupBy("root").agg(F.min("_own").alias("_best"))
    chosen = best.select(F.col("_best.doc_id").alias("_id"), F.col("_best.text_hash").alias("_hash"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_text"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    kept = keyed.join(chosen, same, "left_semi")
    turn = F.row_number().over(Window.partitionBy("_doc", "_text").orderBy("_text"))
    return kept.withColumn("_turn", turn).filter("_turn = 1").select("_row.*")


def hex_of(column: str = "fp") -> Column:
    """A fingerprint as 16 hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
