"""Token ids in wavelet matrix files: random access, counting and occurrences from one compact file per shard.

A shard holds the ids of whole documents in ascending order.  Its distinct ids
are numbered by size, and bit plane k holds bit k of every number, the rows of a
plane being parted by the bits before (zeros first, in order).  A plane is stored
as plain bits with a count of ones per 512 of them, so a shard of s distinct ids
takes log2(s) bits a token and can be memory-mapped and queried as it is.

Spark sorts documents by id into ranges; each task writes its shards whole and
by renaming, so a task that runs again replaces its own files by equal ones.

Defined results: a NULL or empty text has only the end id; NULL ids come first
and are given back as NULL; repeated ids follow each other in the order of their
texts' hashes; an empty table gives no files and an empty result; other columns
are never read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assocframe.llm.common import map_file, new_folder, read_files, write_file
from assocframe.llm.encoding import encoder
from assocframe.plans.materialize import materialize

END_ID = 2
#: A shard is closed after so many tokens; a document is never split.
SHARD_TOKENS = 1 << 21
SUFFIX = ".wmx"
_MAGIC = b"WMX1"
_BLOCK = 512
_HEAD = struct.Struct("<4sBxxxQQQQQ")  # magic, planes, tokens, documents, alphabet, bytes of documents, of directory


class WaveletMatrix:
    """Ids as bit planes; positions and results are numpy arrays."""

    def __init__(self, n: int, alphabet: np.ndarray, zeros: np.ndarray, ones: np.ndarray, planes: np.ndarray) -> None:
        self.n, self.alphabet, self.zeros = n, alphabet, zeros.astype(np.int64)
        self.ones, self.planes = ones, planes  # (planes, blocks): ones before a block; (planes, 64-bit words)

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        alphabet, value = _numbered(ids)
        depth, n = max(1, int(len(alphabet) - 1).bit_length()), len(ids)
        blocks = n // _BLOCK + 1
        planes = np.zeros((depth, blocks * _BLOCK // 8), dtype=np.uint8)
        zeros = np.zeros(depth, dtype=np.int64)
        for k in range(depth):
            bit = (value >> (depth - 1 - k) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            planes[k, : len(packed)] = packed
            low, high = value[~bit], value[bit]
            zeros[k] = len(low)
            value = np.concatenate([low, high])
        words = planes.view("<u8")
        per_block = np.bitwise_count(words).reshape(depth, blocks, -1).sum(axis=2, dtype=np.int64)
        ones = np.cumsum(per_block, axis=1) - per_block
        return cls(n, alphabet, zeros, ones.astype("<u4"), words)

    def _rank1(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane k before each position."""
        block = at // _BLOCK
        words = self.planes[k][block[:, None] * 8 + np.arange(8)]
        left = np.clip(at[:, None] - block[:, None] * _BLOCK - np.arange(8) * 64, 0, 64)
        mask = np.where(left == 64, ~np.uint64(0), (np.uint64(1) << (left % 64).astype(np.uint64)) - np.uint64(1))
        return self.ones[k][block].astype(np.int64) + np.bitwise_count(words & mask).sum(axis=1, dtype=np.int64)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some positions."""
        at = np.asarray(at, dtype=np.int64)
        value = np.zeros(len(at), dtype=np.int64)
        for k in range(len(self.zeros)):
            ones = self._rank1(k, at)
            bit = self._rank1(k, at + 1) - ones
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
            value = value << 1 | bit
        return self.alphabet[value]

    def _walk(self, token: int, low: int, high: int) -> tuple[int, int, list[tuple[int, int]]]:
        """The range of rows that ids ``token`` of [low, high) end up in, and the way there."""
        place = int(np.searchsorted(self.alphabet, token))
        if place == len(self.alphabet) or self.alphabet[place] != token:
            return 0, 0, []
        way, depth = [], len(self.zeros)
        for k in range(depth):
            bit = place >> (depth - 1 - k) & 1
            a, b = self._rank1(k, np.array([low, high]))
            low, high = (self.zeros[k] + a, self.zeros[k] + b) if bit else (low - a, high - b)
            way.append((k, bit))
        return int(low), int(high), way

    def rank(self, token: int, at: int) -> int:
        """How often the id occurs before a position."""
        return self.count(token, 0, at)

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        a, b, _ = self._walk(token, low, self.n if high is None else high)
        return b - a

    def select(self, token: int, number: np.ndarray) -> np.ndarray:
        """Positions of the number-th occurrences (from 0) of an id."""
        low, high, way = self._walk(token, 0, self.n)
        at = low + np.asarray(number, dtype=np.int64)
        if len(at) and (at.min() < low or at.max() >= high):
            raise IndexError("the id does not occur so often")
        for k, bit in reversed(way):
            at = self._select(k, bit, at - self.zeros[k] if bit else at)
        return at

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def _select(self, k: int, bit: int, number: np.ndarray) -> np.ndarray:
        """Positions of the number-th ones (or zeros) of plane k: by block, then inside the block."""
        before = self.ones[k].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * _BLOCK - before
        block = np.searchsorted(before, number, side="right") - 1
        words = self.planes[k][block[:, None] * 8 + np.arange(8)]
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
        run = np.cumsum(bits == bit, axis=1)
        inside = (run > (number - before[block])[:, None]).argmax(axis=1)
        return block * _BLOCK + inside

    def decode(self) -> np.ndarray:
        """All ids: the partings undone plane by plane."""
        depth = len(self.zeros)
        kind = np.uint16 if depth <= 16 else np.uint32
        value = np.zeros(self.n, dtype=kind)
        for k in reversed(range(depth)):
            bit = np.unpackbits(self.planes[k].view(np.uint8), count=self.n, bitorder="little").view(bool)
            before = np.empty_like(value)
            before[~bit] = value[: self.zeros[k]]
            before[bit] = value[self.zeros[k] :]
            value = before | (bit.astype(kind) << kind(depth - 1 - k))
        return self.alphabet[value]


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and each id's place among them."""
    if not len(ids) or int(ids.max()) >= 1 << 24:
        alphabet, value = np.unique(ids, return_inverse=True)
        return alphabet.astype("<u4"), value.astype(np.uint32)
    seen = np.zeros(int(ids.max()) + 1, dtype=bool)
    seen[ids] = True
    number = np.cumsum(seen) - 1
    alphabet = np.flatnonzero(seen).astype("<u4")
    return alphabet, number.astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)[ids]


# Files ----------------------------------------------------------------------------


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """A whole shard file."""
    matrix = WaveletMatrix.build(ids)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    docs = zstandard.compress(known.tobytes() + numbers.tobytes() + np.array(lengths, dtype="<u8").tobytes())
    head = _HEAD.pack(_MAGIC, len(matrix.zeros), len(ids), len(doc_ids), len(matrix.alphabet), len(docs), matrix.ones.shape[1])
    parts = [head, docs, matrix.alphabet.tobytes(), matrix.zeros.astype("<u8").tobytes(), matrix.ones.tobytes()]
    size = sum(map(len, parts))
    return b"".join([*parts, bytes(-size % 8), matrix.planes.tobytes()])


class Shard:
    """A shard file, from its bytes or a memory map of them."""

    def __init__(self, data: np.ndarray) -> None:
        magic, depth, n, documents, alphabet, doc_bytes, blocks = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix file")
        at = _HEAD.size
        table = zstandard.decompress(data[at : at + doc_bytes].tobytes())
        at += doc_bytes
        known = np.frombuffer(table, dtype=np.uint8, count=documents)
        numbers = np.frombuffer(table, dtype="<i8", count=documents, offset=documents)
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known, strict=True)]
        lengths = np.frombuffer(table, dtype="<u8", offset=9 * documents).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * count
            at += size
            return np.frombuffer(data[at - size : at], dtype=kind)

        letters, zeros = take("<u4", alphabet), take("<u8", depth)
        ones = take("<u4", depth * blocks).reshape(depth, blocks)
        at += -at % 8
        self.matrix = WaveletMatrix(n, letters, zeros, ones, take("<u8", depth * blocks * 8).reshape(depth, -1))

    @classmethod
    def open(cls, path: str) -> Shard:
        return cls(map_file(path))


# Spark ----------------------------------------------------------------------------


def write_shards(docs: DataFrame, vocabulary_path: str, folder: str | None = None) -> tuple[str, DataFrame]:
    """Encodes and writes all documents; returns the folder and (name, part, shard, tokens, documents) per file."""
    folder = folder or new_folder(docs.sparkSession, "wavelet")
    order = [F.asc_nulls_first("doc_id"), F.col("text_hash").asc()]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    ranged = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    end = np.array([END_ID], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder(vocabulary_path).encode
        rows: list[dict] = []
        doc_ids: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def put() -> None:
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            name = f"{part:07d}-{len(rows):07d}{SUFFIX}"
            write_file(folder, name, shard_bytes(doc_ids, [len(p) // 4 for p in parts], ids))
            rows.append({"name": name, "part": part, "shard": len(rows), "tokens": len(ids), "documents": len(parts)})
            doc_ids.clear()
            parts.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for doc_id, text in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    doc_ids.append(doc_id)
                    parts.append(encode(text) + end)
                    held += len(parts[-1]) // 4
                    if held >= SHARD_TOKENS:
                        put()
                        held = 0
        if parts:
            put()
        yield pa.RecordBatch.from_pylist(rows, schema=fields)

    kinds = {"name": pa.string(), "part": pa.int64(), "shard": pa.int64(), "tokens": pa.int64(), "documents": pa.int64()}
    fields = pa.schema(list(kinds.items()))
    made = ranged.mapInArrow(write, "name string, part bigint, shard bigint, tokens bigint, documents bigint")
    return folder, materialize(made)


def read_shards(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """name, doc_id, local_start, n_tokens, ids_crc32 (and ids) of every document in the files of a folder."""
    kinds = {"name": pa.string(), "doc_id": pa.int64(), "local_start": pa.int64(), "n_tokens": pa.int64()}
    fields = pa.schema([*kinds.items(), ("ids_crc32", pa.int64()), *([("ids", pa.binary())] if ids else [])])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(np.frombuffer(batch.column(1)[k].as_buffer(), dtype=np.uint8))
                tokens, starts, count = shard.matrix.decode().astype("<u4"), shard.starts, len(shard.doc_ids)
                bits = [tokens[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                columns = [[batch.column(0)[k].as_py()] * count, shard.doc_ids, starts[:-1], np.diff(starts)]
                columns += [[zlib.crc32(b) for b in bits], *([bits] if ids else [])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
                )

    name = F.element_at(F.split("path", "/"), -1).alias("name")
    schema = "name string, doc_id bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids
    return read_files(spark, folder, SUFFIX).select(name, "content").mapInArrow(read, schema)


def with_starts(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """Turns local starts into starts over all files."""
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("part_tokens"))
    # One row per writing task reaches this window.
    before = F.coalesce(F.sum("part_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", before.alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("name", "part", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("in_part"))
    starts = shards.join(offsets, "part").select("name", (F.col("part_start") + F.col("in_part")).alias("shard_start"))
    joined = found.join(starts, "name")
    return joined.withColumn("start", F.col("shard_start") + F.col("local_start")).drop("name", "shard_start", "local_start")
