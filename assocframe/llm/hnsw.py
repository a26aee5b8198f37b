"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Equal vectors are one node that carries the smallest ids of its rows, as many as
a result can ask for, so a very frequent vector is one node and no result is
lost.  Nodes are dealt to shards of about ``SHARD_ROWS`` by a hash of the vector,
so neither a frequent vector nor a dense cluster fills a shard.

A shard's nodes are ordered by level, highest first; the nodes of level ``l`` are
then the first ``n_l`` of them, and the graph is one flat array of neighbour
numbers per level.  Nodes are inserted in batches: each batch walks down the
levels, finds its nearest nodes by beam search, and takes as neighbours those
nearer to itself than to one another, the rest filled up by distance; the new
links are also entered backwards.  Beams of many nodes move in step, so all work
is numpy on arrays.  Files are written under a name of their own and renamed.

Queries are written in blocks.  A task maps one shard's file, searches a block,
and scores what it found on the original vectors in double precision; the
nearest of all shards are the result.  Rows moved between tasks: vectors three
times (equal rows, equal vectors, shards) and ``k`` results per query and shard.

Every query meets every shard, as its method says; a larger ``SHARD_ROWS`` makes
that fewer.  Recall against brute force is held by tests at 0.9 or more.

Odd cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part; vectors of another length are no candidates; rows equal
in id and vector are one; an id with two vectors is two rows, and one of them
does not leave out the other; a NULL id is never a query and comes last among
ties; ids are whole numbers; other columns are not looked at; an empty table gives an empty one; very
long vectors only make shards larger.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assocframe.llm.common import _open_fs, map_file, mix64, new_folder, write_file
from assocframe.plans.materialize import materialize

SHARD_ROWS = 16_384
QUERY_BLOCK = 2_048
LINKS = 16  # of a node; twice as many on the lowest level, where links are entered backwards too
BEAM_BUILD = 48
BEAM_SEARCH = 256
_BATCH = 512
_FIRST = 1_024  # nodes of a level that are compared with each other instead of searched
_EXPAND = 4
_TASKS = 10_000

_MISSING = np.iinfo(np.int64).max  # a NULL id: last among ties


# Beam search ----------------------------------------------------------------------


def distances(vectors: np.ndarray, nodes: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Squared distances of pairs (node, query)."""
    gap = vectors[nodes] - queries[rows]
    return np.einsum("ij,ij->i", gap, gap)


def beam_search(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes met by each query and their squared distances, nearest first; -1 where fewer.

    All beams move in step: each one expands its nearest nodes not yet expanded,
    until none is left in it.
    """
    count, n = len(queries), len(links)
    seen = np.zeros((count, n), dtype=bool)
    nodes = np.full((count, width), -1, dtype=np.int32)
    near = np.full((count, width), np.inf, dtype=np.float32)
    fresh = np.zeros((count, width), dtype=bool)
    every = np.arange(count)
    nodes[:, 0], fresh[:, 0] = start, True
    near[:, 0] = distances(vectors, start, queries, every)
    seen[every, start] = True
    flat, active = seen.reshape(-1), every
    while True:
        active = active[fresh[active].any(axis=1)]
        if not len(active):
            return nodes, near
        wanted = fresh[active]
        wanted &= np.cumsum(wanted, axis=1) <= _EXPAND
        at, place = np.nonzero(wanted)
        rows = active[at]
        fresh[rows, place] = False
        met = links[nodes[rows, place]]
        key = (rows[:, None] * np.int64(n) + met)[met >= 0]
        key = np.sort(key[~flat[key]])
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        flat[key] = True
        rows, found = key // n, key % n
        gap = distances(vectors, found, queries, rows)
        better = gap < near[rows, -1]
        rows, found, gap = rows[better], found[better], gap[better]
        if len(rows):
            _merge(nodes, near, fresh, rows, found, gap)


def _merge(nodes, near, fresh, rows, found, gap) -> None:
    """Put newly met nodes (sorted by query) into the beams."""
    hit, first, counts = np.unique(rows, return_index=True, return_counts=True)
    width, more = near.shape[1], counts.max()
    line, place = np.repeat(np.arange(len(hit)), counts), np.arange(len(rows)) - np.repeat(first, counts)
    added = np.full((len(hit), more), np.inf, dtype=np.float32)
    names = np.full((len(hit), more), -1, dtype=np.int32)
    added[line, place], names[line, place] = gap, found
    all_near = np.concatenate([near[hit], added], axis=1)
    order = np.argsort(all_near, axis=1, kind="stable")[:, :width]
    near[hit] = np.take_along_axis(all_near, order, axis=1)
    nodes[hit] = np.take_along_axis(np.concatenate([nodes[hit], names], axis=1), order, axis=1)
    open_now = np.concatenate([fresh[hit], names >= 0], axis=1)
    fresh[hit] = np.take_along_axis(open_now, order, axis=1)


# Building -------------------------------------------------------------------------


def diverse(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's candidates, nearest first, those nearer to the row than to a kept one; then the nearest others."""
    rows, width = nodes.shape
    chosen = np.zeros((rows, width), dtype=bool)
    for at in range(0, rows, 256):
        block = slice(at, at + 256)
        points = vectors[np.maximum(nodes[block], 0)]
        norms = np.einsum("ijk,ijk->ij", points, points)
        apart = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        mine, own = chosen[block], near[block]
        count = np.zeros(len(own), dtype=int)
        for j in range(width):
            free = ((apart[:, j] >= own[:, j, None]) | ~mine).all(axis=1) & np.isfinite(own[:, j]) & (count < keep)
            mine[:, j] = free
            count += free
    order = np.argsort(np.where(chosen, 0, np.where(np.isfinite(near), 1, 2)), axis=1, kind="stable")[:, :keep]
    near = np.take_along_axis(near, order, axis=1)
    return np.where(np.isfinite(near), np.take_along_axis(nodes, order, axis=1), -1), near


class Level:
    """Neighbours of the first nodes of a shard and their squared distances, while links are entered."""

    def __init__(self, vectors: np.ndarray, links: int):
        self.vectors = vectors
        self.nodes = np.full((len(vectors), links), -1, dtype=np.int32)
        self.near = np.full((len(vectors), links), np.inf, dtype=np.float32)

    def enter(self, new: np.ndarray, candidates: np.ndarray, near: np.ndarray) -> None:
        """Link ``new`` nodes with the best of their candidates, nearest first, in both directions."""
        width = self.nodes.shape[1]
        nodes, gaps = diverse(self.vectors, candidates, near, min(LINKS, width))
        self.nodes[new, : nodes.shape[1]], self.near[new, : nodes.shape[1]] = nodes, gaps
        source, target, gap = np.repeat(new, nodes.shape[1]), nodes.ravel(), gaps.ravel()
        real = target >= 0
        source, target, gap = source[real], target[real], gap[real]
        order = np.lexsort((gap, target))
        source, target, gap = source[order], target[order], gap[order]
        hit, first, counts = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, counts)
        # The nearest ones suffice: no list keeps more.
        line, kept = np.repeat(np.arange(len(hit)), counts), place < width
        names = np.full((len(hit), width), -1, dtype=np.int32)
        gaps = np.full((len(hit), width), np.inf, dtype=np.float32)
        names[line[kept], place[kept]], gaps[line[kept], place[kept]] = source[kept], gap[kept]
        # A link that both ends chose is entered once.
        twice = (names[:, :, None] == self.nodes[hit][:, None, :]).any(axis=2)
        gaps[twice] = np.inf
        names = np.concatenate([self.nodes[hit], names], axis=1)
        gaps = np.concatenate([self.near[hit], gaps], axis=1)
        order = np.argsort(gaps, axis=1, kind="stable")
        names, gaps = np.take_along_axis(names, order, axis=1), np.take_along_axis(gaps, order, axis=1)
        full = np.isfinite(gaps[:, width])
        self.nodes[hit[~full]] = np.where(np.isfinite(gaps), names, -1)[~full, :width]
        self.near[hit[~full]] = gaps[~full, :width]
        if full.any():
            longest = int(np.isfinite(gaps[full]).sum(axis=1).max())
            shrunk = diverse(self.vectors, names[full, :longest], gaps[full, :longest], width)
            self.nodes[hit[full]], self.near[hit[full]] = shrunk


def levels_of(n: int, seed: int = 42) -> np.ndarray:
    """A level per node, each one holding a ``LINKS``-th of the one below."""
    draw = (mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) >> np.uint64(11)).astype(float) / (1 << 53)
    return np.floor(-np.log(np.maximum(draw, 1e-300)) / np.log(LINKS)).astype(int)


def build(vectors: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of the nodes and, from the lowest level up, the neighbours of each level's nodes in that order."""
    level = levels_of(len(vectors))
    order = np.argsort(-level, kind="stable")
    vectors = np.ascontiguousarray(vectors[order], dtype=np.float32)
    graph: list[np.ndarray] = []
    for at in range(level.max(), -1, -1):
        size = int((level >= at).sum())
        graph.insert(0, _build_level(vectors[:size], graph, LINKS if at else 2 * LINKS))
    return order, graph


def _build_level(vectors: np.ndarray, above: list[np.ndarray], links: int) -> np.ndarray:
    level, size = Level(vectors, links), len(vectors)
    done = min(size, _FIRST)
    level.enter(np.arange(done), *_nearest_of(vectors[:done], vectors[:done], np.arange(done)))
    while done < size:
        new = np.arange(done, min(size, done + _BATCH))
        queries = vectors[new]
        start = descend(vectors, above, queries)
        start[start >= done] = 0  # not entered here yet
        found = beam_search(vectors, level.nodes[:done], queries, start, BEAM_BUILD)
        # Nodes of one batch see each other as well.
        own = _nearest_of(queries, queries, np.arange(len(new)))
        nodes = np.concatenate([found[0], np.where(own[0] >= 0, own[0] + done, -1)], axis=1)
        near = np.concatenate([found[1], own[1]], axis=1)
        order = np.argsort(near, axis=1, kind="stable")[:, :BEAM_BUILD]
        level.enter(new, np.take_along_axis(nodes, order, axis=1), np.take_along_axis(near, order, axis=1))
        done = new[-1] + 1
    return level.nodes


def _nearest_of(points: np.ndarray, queries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nearest points but its own, by comparing all of these few."""
    apart = (queries**2).sum(axis=1)[:, None] + (points**2).sum(axis=1)[None] - 2 * queries @ points.T
    apart[np.arange(len(queries)), own] = np.inf
    order = np.argsort(apart, axis=1, kind="stable")[:, : min(BEAM_BUILD, len(points))]
    near = np.maximum(np.take_along_axis(apart, order, axis=1), 0).astype(np.float32)
    return np.where(np.isfinite(near), order, -1).astype(np.int32), near


def descend(vectors: np.ndarray, above: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """The node at which each query enters the level below ``above``."""
    at = np.zeros(len(queries), dtype=np.int32)
    for links in reversed(above):
        at = beam_search(vectors, links, queries, at, 4)[0][:, 0]
    return at


def search(vectors: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, width: int) -> np.ndarray:
    """The nodes nearest to each query that the graph leads to; -1 where fewer than ``width``."""
    found = []
    for at in range(0, len(queries), _BATCH):
        block = queries[at : at + _BATCH]
        start = descend(vectors, graph[1:], block)
        found.append(beam_search(vectors, graph[0], block, start, width)[0])
    return np.concatenate(found)


# Files ----------------------------------------------------------------------------


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays one after the other behind a line that tells where each one lies."""
    places, at = {}, 0
    for name, x in arrays.items():
        places[name] = [x.dtype.str, list(x.shape), at]
        at += -(-x.nbytes // 8) * 8
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    return head + b"".join(x.tobytes() + b"\0" * (-x.nbytes % 8) for x in arrays.values())


def unpack(data: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of ``pack``, as views of a mapped file."""
    size = 256
    while not (end := np.flatnonzero(data[:size] == 10)).size:
        size *= 2
    start, out = int(end[0]) + 1, {}
    for name, (kind, shape, at) in json.loads(bytes(data[: start - 1])).items():
        count = int(np.prod(shape))
        view = data[start + at : start + at + count * np.dtype(kind).itemsize].view(kind)
        out[name] = view.reshape(shape)
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


# Spark ----------------------------------------------------------------------------


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, vector and its length of the rows that take part, each once."""
    value = F.col(vector)
    wide = vectors.select("vec_id", value.alias("vector")).filter(F.col("vector").isNotNull() & (F.size("vector") > 0))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return wide.filter(sound & some).distinct()


def _nodes(rows: DataFrame, ids: int) -> DataFrame:
    """One row per distinct vector with its ``ids`` smallest ids, in order; NULL last."""
    order = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= ids)
    entry = F.struct("_at", "vec_id")
    listed = few.groupBy("vector").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    return listed.select("vector", F.transform("l", lambda e: e["vec_id"]).alias("ids"), F.size("vector").alias("dim"))


def build_shards(rows: DataFrame, ids: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write a graph per shard; dim, shard, rows, scale and path of each, written down so that they are built once."""
    spark = rows.sparkSession
    nodes = materialize(_nodes(rows, ids))
    # Vectors are scaled for the search, so that squares of single precision neither overflow nor vanish.
    total, scale = nodes.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))).first()
    shards = max(1, -(-total // shard_rows))
    folder = new_folder(spark, "hnsw")
    scale = float(scale or 1.0)

    def write(table: pa.Table) -> pa.Table:
        lists = table["ids"].to_pylist()
        first = np.array([_MISSING if x[0] is None else x[0] for x in lists], dtype=np.int64)
        original = _matrix(table["vector"])
        place = np.lexsort((*original.T[::-1], first))  # the same graph whatever order the rows came in
        order, graph = build(original[place].astype(np.float64) / scale)
        order = place[order]
        held = [lists[i] for i in order]
        arrays = {
            "vectors": np.ascontiguousarray(original[order]),
            "starts": np.cumsum([0, *map(len, held)]).astype(np.int64),
            "ids": np.array([_MISSING if x is None else x for h in held for x in h], dtype=np.int64),
        } | {f"links{k}": x for k, x in enumerate(graph)}
        dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
        path = write_file(folder, f"shard-{dim}-{shard}.hnsw", pack(arrays))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()), "rows": [len(held)], "path": [path]})

    # Partitions asked for by number, as small shards take time all the same.
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards))).repartition(min(shards, _TASKS), "dim", "shard")
    files = dealt.groupBy("dim", "shard").applyInArrow(write, "dim int, shard long, rows long, path string")
    return materialize(files.withColumn("scale", F.lit(scale)))


def nearest(rows: DataFrame, queries: Column, k: int = 10, shard_rows: int = SHARD_ROWS, width: int = BEAM_SEARCH) -> DataFrame:
    """query_id, rank, vec_id and score (distance) of the ``k`` nearest rows found for every row that ``queries`` picks.

    ``rows`` are those of ``usable``.
    """
    spark = rows.sparkSession
    rows = materialize(rows)
    files = build_shards(rows, k + 1, shard_rows)
    asked = materialize(rows.filter(queries).withColumn("query", F.monotonically_increasing_id()))
    blocks = _write_blocks(spark, asked)
    pairs = blocks.join(F.broadcast(files), "dim") if _few(files) else blocks.join(files, "dim")
    # A block and a shard a row: file names travel, not vectors.
    pairs = materialize(pairs)
    spread = pairs.repartition(max(1, min(pairs.count(), _TASKS)))
    found = _search_pairs(spread, k, width)
    order = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _few(files: DataFrame) -> bool:
    return files.limit(100_001).count() <= 100_000


def _write_blocks(spark: SparkSession, asked: DataFrame) -> DataFrame:
    """Files of at most ``QUERY_BLOCK`` query vectors; their block, dim and path."""
    folder = new_folder(spark, "queries")
    target = f"{folder}/blocks"
    asked.write.option("maxRecordsPerFile", QUERY_BLOCK).parquet(target)
    asked = spark.read.schema(asked.schema).parquet(target)
    where = asked.select(F.col("_metadata.file_path").alias("block"), F.size("vector").alias("dim"))
    return materialize(where.distinct())


def _search_pairs(pairs: DataFrame, k: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                yield _search_pair(pair, k, width)

    return pairs.mapInArrow(run, "query long, query_id long, vec_id long, score double")


def _search_pair(pair: dict, k: int, width: int) -> pa.RecordBatch:
    where, path = _open_fs(pair["block"])
    asked = pq.read_table(path, filesystem=where, columns=["query", "vec_id", "vector"])
    lengths = asked["vector"].combine_chunks().value_lengths().to_numpy()
    asked = asked.filter(pa.array(lengths == pair["dim"]))
    queries = _matrix(asked["vector"]).astype(np.float64)
    shard = unpack(map_file(pair["path"]))
    original = shard["vectors"]
    scaled = (original / pair["scale"]).astype(np.float32)
    graph = [shard[f"links{i}"] for i in range(len(shard) - 3)]
    nodes = search(scaled, graph, (queries / pair["scale"]).astype(np.float32), min(width, len(original)))
    starts, ids = shard["starts"], shard["ids"]
    out: dict[str, list] = {"query": [], "query_id": [], "vec_id": [], "score": []}
    for query, own, vector, row in zip(asked["query"].to_pylist(), asked["vec_id"].to_pylist(), queries, nodes):
        row = row[row >= 0]
        gap = np.sqrt(((original[row].astype(np.float64) - vector) ** 2).sum(axis=1))
        counts = starts[row + 1] - starts[row]
        each = np.repeat(gap, counts)
        named = np.concatenate([ids[starts[i] : starts[i + 1]] for i in row])
        other = ~((named == own) & (each == 0))
        each, named = each[other], named[other]
        best = np.lexsort((named, each))[:k]
        out["query"] += [query] * len(best)
        out["query_id"] += [own] * len(best)
        out["vec_id"] += [None if x == _MISSING else int(x) for x in named[best]]
        out["score"] += each[best].tolist()
    return pa.RecordBatch.from_pydict(
        out, schema=pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    )
