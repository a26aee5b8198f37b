"""Best-fit packing of token pieces into sequences under several capacities.

A piece asks for tokens, one document slot and attention cost (its length
squared, as pieces attend within themselves); a sequence offers a capacity of
each.  Pieces are placed in falling order of their weighted demand.  Of the open
sequences with room in every capacity, the one with the smallest residual norm
after the piece is chosen, or the one of the largest weighted dot-product of
residual and demand.  A piece that fits nowhere opens a sequence.

Spark deals pieces into blocks of about BLOCK by a hash and packs each block on
its own: a block wastes less than one sequence beyond what packing all at once
would, so the loss is below one in a thousand sequences, and no task ever holds
more than a few blocks.  Pieces that fill a sequence are not packed.

Defined results: a NULL or empty text is a piece that holds the end id alone;
NULL and repeated ids are documents like others, and repeated rows are packed
each; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.llm.encoding import encoder
from assocframe.plans.materialize import materialize

BLOCK = 8_192
END_ID = 1


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds at most, and the weight of each capacity in the choice of a sequence."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)

    def totals(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def best_fit(lengths: np.ndarray, caps: Capacities, rule: str = "residual_norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces must fit an empty sequence."""
    n = len(lengths)
    demand = np.stack([lengths, np.ones(n), lengths.astype(np.float64) ** 2], axis=1) / caps.totals()
    weights = np.array(caps.weights)
    where, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    room = np.empty((n, 3))  # of the sequences that are open, as shares of the capacities
    name = np.empty(n, dtype=np.int64)
    used = np.zeros(n, dtype=np.int64)
    opened = alive = 0
    smallest = demand.min(axis=0) if n else None
    for i in np.lexsort((np.arange(n), -(demand @ weights))):
        ask = demand[i]
        fits = (room[:alive] >= ask - 1e-12).all(axis=1)
        if fits.any():
            if rule == "dot_product":
                worth = (room[:alive] * ask) @ weights
            else:
                worth = -(((room[:alive] - ask) ** 2) @ weights)
            k = int(np.where(fits, worth, -np.inf).argmax())
        else:
            k = alive
            room[k], name[k] = 1.0, opened
            opened += 1
            alive += 1
        where[i], offset[i] = name[k], used[name[k]]
        used[name[k]] += int(lengths[i])
        room[k] -= ask
        if (room[k] < smallest - 1e-12).any():  # nothing fits any more: the last open one takes its place
            alive -= 1
            room[k], name[k] = room[alive], name[alive]
    return where, offset


# Spark ----------------------------------------------------------------------------


def pieces(docs: DataFrame, vocabulary_path: str, caps: Capacities = Capacities(), ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([END_ID], dtype="<u4").tobytes()
    width = 4 * caps.tokens
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * ids
    id_type = pa.int64() if kind == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: list[list] = [[] for _ in range(6)]
                part = batch.slice(at, 256)
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    data = encode(text) + end
                    for k, begin in enumerate(range(0, len(data), width)):
                        piece = data[begin : begin + width]
                        row = (doc_id, k, begin // 4, len(piece) // 4, zlib.crc32(piece), piece)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                types = [id_type or part.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if ids else 5]
                arrays = [pa.array(c, type=t) for c, t in zip(out, types, strict=True)][: len(names)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(cut: DataFrame, caps: Capacities = Capacities(), block: int = BLOCK, rule: str = "residual_norm") -> DataFrame:
    """Adds sequence_id and offset to rows with ``length`` (1 to caps.tokens).

    The rows are written to the checkpoint folder first: they are counted, to
    know how many blocks there are, and a row's block is drawn from its place in
    those files, so that neither reruns of tasks nor repeated rows disturb it.
    """
    kept = [c for c in cut.columns if c not in ("sequence_id", "offset")]
    cut = materialize(cut.select(*[F.col(f"`{c}`") for c in kept]))
    place_in_files = F.monotonically_increasing_id()
    full = F.col("length") >= caps.tokens
    blocks = max(1, -(-cut.filter(~full).count() // block))
    # Full pieces are sequences of their own: they get numbers beyond those of the blocks.
    alone = cut.withColumn("sequence_id", F.lit(1 << 62) + place_in_files).filter(full)
    alone = alone.withColumn("offset", F.lit(0).cast("bigint"))
    dealt = cut.withColumn("_block", F.pmod(F.xxhash64(place_in_files), F.lit(blocks))).filter(~full)

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "ids_crc32"] if "ids_crc32" in frame else ["length"], kind="stable")
        where, offset = best_fit(frame["length"].to_numpy(), caps, rule)
        frame["sequence_id"] = frame["_block"].to_numpy() * (1 << 32) + where
        frame["offset"] = offset
        return frame.drop(columns="_block")

    return dealt.groupBy("_block").applyInPandas(place, alone.schema).unionByName(alone)
