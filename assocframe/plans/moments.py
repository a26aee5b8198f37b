"""Correlations of many columns in one scan.

Each task adds up centred products of its rows, batch by batch, for all columns
at once.  The square of columns is cut into blocks, so that sums of different
tasks are added block by block, in two steps, by many tasks.  A block carries
means and sums of squares of its rows and columns and so is complete in itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.roles import col

_BLOCK = 64
_SALTS = 32
_SCHEMA = "a int, b int, salt int, n long, sums array<double>"
_ARROW = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("salt", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.float64()))])


class Moments:
    """Rows seen, means, and sums of products of deviations from them."""

    def __init__(self, n: int, left: np.ndarray, right: np.ndarray, left_squares: np.ndarray, right_squares: np.ndarray, products: np.ndarray):
        self.n, self.left, self.right = n, left, right
        self.left_squares, self.right_squares, self.products = left_squares, right_squares, products

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        centred = x - mean
        products = centred.T @ centred
        return cls(len(x), mean, mean, products.diagonal().copy(), products.diagonal().copy(), products)

    def add(self, other: Moments) -> Moments:
        n = self.n + other.n
        left, right, both = other.left - self.left, other.right - self.right, self.n * other.n / n
        return Moments(
            n, self.left + left * (other.n / n), self.right + right * (other.n / n),
            self.left_squares + other.left_squares + left**2 * both, self.right_squares + other.right_squares + right**2 * both,
            self.products + other.products + np.outer(left, right) * both,
        )

    def block(self, a: slice, b: slice) -> np.ndarray:
        return np.concatenate([self.left[a], self.right[b], self.left_squares[a], self.right_squares[b], self.products[a, b].ravel()])

    @classmethod
    def from_block(cls, n: int, sums: np.ndarray, rows: int) -> Moments:
        columns = (len(sums) - 2 * rows) // (rows + 2)
        left, right, left_squares, right_squares, products = np.split(sums, np.cumsum([rows, columns, rows, columns]))
        return cls(n, left, right, left_squares, right_squares, products.reshape(rows, columns))


def pearson_of_columns(complete: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``col_a, col_b, r`` of all pairs of ``columns``, doubles without NULL; r is NULL where a column is constant."""
    names, p = list(columns), len(columns)
    spans = [slice(at, min(at + _BLOCK, p)) for at in range(0, p, _BLOCK)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % _SALTS
        found = None
        for batch in batches:
            if batch.num_rows:
                own = Moments.of(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
                found = own if found is None else found.add(own)
        if found is not None:
            for a, one in enumerate(spans):
                for b in range(a, len(spans)):
                    yield pa.RecordBatch.from_pylist([{"a": a, "b": b, "salt": salt, "n": found.n, "sums": found.block(one, spans[b])}], schema=_ARROW)

    def merged(table: pa.Table) -> Moments:
        a, found = table["a"][0].as_py(), None
        for n, sums in zip(table["n"].to_pylist(), table["sums"]):
            own = Moments.from_block(n, np.asarray(sums.values), spans[a].stop - spans[a].start)
            found = own if found is None else found.add(own)
        return found

    def add(table: pa.Table) -> pa.Table:
        found = merged(table)
        row = {k: table[k][0].as_py() for k in ("a", "b", "salt")} | {"n": found.n, "sums": found.block(slice(None), slice(None))}
        return pa.Table.from_pylist([row], schema=_ARROW)

    def finish(table: pa.Table) -> pa.Table:
        found, a, b = merged(table), spans[table["a"][0].as_py()], spans[table["b"][0].as_py()]
        size = np.sqrt(np.outer(found.left_squares, found.right_squares))
        r = found.products / np.where(size > 0, size, np.nan)
        rows = [(names[i], names[j], r[i - a.start, j - b.start]) for i in range(a.start, a.stop) for j in range(max(i + 1, b.start), b.stop)]
        first, second, values = zip(*rows) if rows else ((), (), ())
        return pa.table({"col_a": pa.array(first, pa.string()), "col_b": pa.array(second, pa.string()), "r": pa.array(values, pa.float64(), from_pandas=True)})

    plain = complete.select(*[col(c).alias(f"c{i}") for i, c in enumerate(names)])
    partial = plain.mapInArrow(scan, _SCHEMA)
    summed = partial.groupBy("a", "b", "salt").applyInArrow(add, _SCHEMA)
    found = summed.groupBy("a", "b").applyInArrow(finish, "col_a string, col_b string, r double")
    every = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    # An empty table has pairs too, without a figure.
    pairs = complete.sparkSession.createDataFrame(every, "col_a string, col_b string")
    return pairs.join(F.broadcast(found), ["col_a", "col_b"], "left")
