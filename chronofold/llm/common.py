"""Helpers shared by the training-data operators: narrow Arrow maps, shared tables, word shingles."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a slice end when their texts reach so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Rows of an Arrow batch while a table is stored.
BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[list[list]]:
    """Columns of each batch as Python lists, cut so that one slice holds about SLICE_BYTES of column ``text``."""
    for batch in batches:
        for part in cut(batch, text):
            yield [c.to_pylist() for c in part.columns]


def map_slices(df: DataFrame, schema: str, make: Callable[[], Callable[[list[list]], list[list]]], text: int = 1, after: Callable[[], None] | None = None) -> DataFrame:
    """A narrow map: ``make()`` runs once in each task and returns the function from a slice's columns to result columns.
    ``after()`` runs when a task has read its rows."""
    from pyspark.sql.types import StructType, _parse_datatype_string  # noqa: PLC2701

    kinds: StructType = _parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for columns in slices(batches, text):
            out = step(columns)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)
        if after:
            after()
        release()

    return df.mapInArrow(run, kinds)


def release() -> None:
    """Gives a worker's free memory back, as Spark keeps workers for the tasks of later operators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def cut(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts, without a copy, of about SLICE_BYTES of column ``text`` each."""
    step = max(1, int(SLICE_BYTES / max(1.0, batch.column(text).nbytes / max(1, batch.num_rows))))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def filter_texts(docs: DataFrame, text_col: str, stays: Callable[[str | None], bool]) -> DataFrame:
    """The rows, with all columns, whose text ``stays``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, at):
                yield part.filter(pa.array([stays(t) for t in part.column(at).to_pylist()], pa.bool_()))
        release()

    return docs.mapInArrow(run, docs.schema)


def replace_texts(docs: DataFrame, text_col: str, change: Callable[[str], str]) -> DataFrame:
    """All rows and columns, with each text changed; null texts stay null."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, at):
                texts = [None if t is None else change(t) for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
        release()

    return docs.mapInArrow(run, docs.schema)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where the setting is missing (local runs, tests) a local one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = os.path.join(tempfile.gettempdir(), "chronofold-shared")
    return f"{base.rstrip('/')}/chronofold-{uuid.uuid4().hex}"


@contextmanager
def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """While a table is written, Arrow batches have ``rows`` rows at most, so that texts and sets come in few MB. The
    session's setting is put back; a lower one stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, and survives lost executors."""
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}.parquet"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with short_batches(spark):
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Removes tables made by stored() that no later plan reads."""
    for df in frames:
        if path := getattr(df, "_stored_at", None):
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def tasks_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Word shingles ---------------------------------------------------------------------------------------------

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse modulo 2**64, grown by doubling."""
    global _powers
    up, down = _powers
    inverse = np.uint64(pow(_BASE, -1, 1 << 64))
    while len(up) < n:
        k = len(up)
        with np.errstate(over="ignore"):
            up = np.concatenate([up, up * (up[-1] * np.uint64(_BASE))])
            down = np.concatenate([down, down * (down[-1] * inverse)])
        assert len(up) == 2 * k
    _powers = (up, down)
    return up, down


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, with A-Z in lower case."""
    if not text:
        return np.empty(0, np.uint64)
    a = np.frombuffer(text, np.uint8)
    word = np.zeros(len(a) + 2, np.int8)
    word[1:-1] = ~_SPACE[a]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(a) + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((_FOLD[a].astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=run[1:])
        return mix64((run[ends] - run[starts]) * down[starts])


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """The sorted set of hashes of runs of ``size`` words; with fewer words, of the whole sequence; without words, empty."""
    words = word_hashes(text)
    return shingles_of(words, size)


def shingles_of(words: np.ndarray, size: int, distinct: bool = True) -> np.ndarray:
    if not len(words):
        return words
    n = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - n + 1, np.uint64(n * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF))
        for j in range(n):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[j : len(words) - n + 1 + j]
        total = mix64(total)
    return np.unique(total) if distinct else total


class MinHash:
    """``k`` universal hash permutations (multiply-add-shift over 64 bits) of 32-bit shingle values."""

    EMPTY = np.uint32(0xFFFFFFFF)

    def __init__(self, k: int, seed: int = 1) -> None:
        draw = np.random.Generator(np.random.PCG64(seed))
        self.a = draw.integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)
        self.k = k

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The least value under each permutation, in blocks of bounded memory; all ones for an empty set."""
        best = np.full(self.k, 0xFFFFFFFFFFFFFFFF, np.uint64)
        x = shingles >> np.uint64(32)
        with np.errstate(over="ignore"):
            rows = max(1, 32_768 // self.k)
            for at in range(0, len(x), rows):
                block = x[at : at + rows, None] * self.a
                block += self.b
                np.minimum(best, block.min(axis=0), out=best)
        return (best >> np.uint64(32)).astype(np.uint32)


def crc_text(column: str) -> F.Column:
    """crc32 of the decimal text of an id, as long."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
