"""What several operators share: words, hashes, batches of rows, files in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assocframe.plans.materialize import shared_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

MASK64 = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the six ASCII white spaces."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def lower_words_of(text: str | None) -> list[bytes]:
    """The words with A-Z in lower case; ``bytes.lower`` leaves all other letters alone."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def fold_of(doc_id: str | Column, parts: int) -> Column:
    """Which of ``parts`` folds a document is in: crc32 of its id as text; a NULL id is in fold 0."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0))


def map_rows(
    df: DataFrame, fn: Callable[[list[dict]], dict[str, list]], schema: str, rows: int = 512
) -> DataFrame:
    """Apply ``fn`` to lists of at most ``rows`` rows; it returns columns, one value per row.

    Spark bounds the bytes of an Arrow batch; only ``rows`` of its rows become
    Python objects at a time.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = fn(batch.slice(start, rows).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return x


# Files ----------------------------------------------------------------------------


def new_folder(spark: SparkSession, name: str) -> str:
    """An empty folder of its own for one run, in the folder that all executors share."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jfs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    jfs.mkdirs(jpath)
    return str(jfs.makeQualified(jpath).toString())


def write_file(folder: str, name: str, data: bytes) -> str:
    """Write a whole file under a name of its own and rename it: a task that runs twice does no harm."""
    target = f"{folder}/{name}"
    where, path = _open_fs(target)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with where.open_output_stream(draft) as out:
        out.write(data)
    where.move(draft, path)
    return target


def map_file(path: str) -> np.ndarray:
    """The bytes of a file, memory-mapped where the shared folder is mounted, else read once."""
    where, inner = _open_fs(path)
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(inner, dtype=np.uint8, mode="r")
    with where.open_input_file(inner) as source:
        return np.frombuffer(source.read(), dtype=np.uint8)


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def read_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """One row per file: path, length, content.  Spark opens the files, wherever they are."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)


def keep_rows(df: DataFrame, column: str, verdicts: Callable[[list], list[bool]], rows: int = 512) -> DataFrame:
    """The rows of ``df`` whose value in ``column`` passes; all columns stay as they are, whatever their names."""
    place = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                yield part.filter(pa.array(verdicts(part.column(place).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)
