"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import scratch_table_path

#: Texts handled together inside a task; bounds a task's memory.
CHARS_AT_ONCE = 4_000_000
#: Rows of a batch in long sessions, see ``small_batches``.
ROWS_AT_ONCE = 2000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, and every later read sees the same rows whatever executor is lost."""
    spark = df.sparkSession
    path = scratch_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on Python workers of the session get ROWS_AT_ONCE rows a batch at
    most, unless it names a number of its own: a batch of whole texts is held by
    the task's JVM and by its worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":  # Spark's default
        spark.conf.set(name, str(ROWS_AT_ONCE))


def give_back() -> None:
    """Return freed memory to the system: Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a task's batches that gives memory back when the task ends; an executor's idle workers would hold it."""
    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def row_key() -> Column:
    """Key of a document row. Rows that agree in doc_id and text share it (and
    get the same result); a null doc_id is a value of its own."""
    return F.xxhash64(F.lit("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00null")), F.col("text"))


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text modulo ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(n)


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           at_once: int = CHARS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``at_once`` bytes of
    text (one long text may be more)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(column))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0))
        piece = np.cumsum(sizes) // at_once
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield b.slice(int(lo), int(hi - lo))


_C = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit hash."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _C[0]
    x ^= x >> np.uint64(27)
    x *= _C[1]
    x ^= x >> np.uint64(31)
    return x


#: Words that a worker's tables keep. An executor holds several workers, idle ones of earlier stages too.
WORDS_KEPT = 150_000


class WordHashes(dict):
    """64-bit hash of a word's bytes, kept for words seen lately."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (none if fewer)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(m, n, np.uint64)
    for j in range(n):
        acc = (acc ^ (acc >> np.uint64(29))) * _ODD[j % 5] + h[j:j + m]
    return mix64(acc)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def lists(values: np.ndarray, sizes: list[int], kind: pa.DataType) -> pa.ListArray:
    """Arrow list column from flat values and the size of each list."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
