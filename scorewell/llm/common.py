"""Helpers shared by the corpus operators: tables, written intermediates, words.

Word hashes are 64-bit and stand for the words themselves; two different
words meet with a chance of about ``n^2 / 2^65`` among n distinct words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.session import scratch_location

#: Bytes of text that one vectorised step looks at.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as Parquet in the shared folder and read again, and the folder, for ``removed``."""
    spark = df.sparkSession
    path = scratch_location(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``stored`` wrote and that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read again: cuts lineage
    and gives the planner a measured size."""
    return stored(df, label)[0]


def free_prefix(df: DataFrame, prefix: str) -> str:
    """``prefix``, or a longer one that no column of ``df`` begins with."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def fold_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def blank_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


# --- texts of an Arrow batch ---------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty texts, without copies."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n, bufs = len(column), column.buffers()
    if n == 0 or bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(bufs[1], width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def byte_table(is_word, lower: bool = True) -> np.ndarray:
    """For each byte its (lower-cased) value if it belongs to a word, else 0."""
    t = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        if is_word(c):
            t[b] = c
    return t


#: Words are runs of anything but ASCII white space; A-Z count as a-z.
#: (A NUL byte belongs to a word, so it is written as 255, which UTF-8 never has.)
SPACED = byte_table(lambda c: c != 0x20 and not 0x09 <= c <= 0x0D)
SPACED[0] = 255
#: Words are runs of letters and digits and of anything beyond ASCII.
ALNUM = byte_table(lambda c: c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(0, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        with np.errstate(over="ignore"):
            p = np.full(max(n, 64, 2 * len(_POWERS)), _BASE, np.uint64)
            p[0] = 1
            _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def words(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, start byte, end byte, number of words before each document) of all words.

    Works through the bytes in blocks that end between words, so that memory
    besides the result stays bounded however long a text is.
    """
    hs, ss, es, at = [], [], [], 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        while end < len(data) and kinds[data[end - 1]] and kinds[data[end]]:
            tail = kinds[data[end : end + BLOCK_BYTES]]
            stop = int(np.argmin(tail != 0)) if not tail.all() else len(tail)
            end += max(stop, 1)
        v = kinds[data[at:end]]
        on = v != 0
        cut = np.zeros(len(v) + 1, bool)  # a document begins here
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        cut[inside] = True
        before = np.empty_like(on)
        before[0], before[1:] = False, on[:-1]
        s = np.flatnonzero(on & (~before | cut[:-1]))
        if len(s):
            after = np.empty_like(on)
            after[-1], after[:-1] = False, on[1:]
            e = np.flatnonzero(on & (~after | cut[1:])) + 1
            w = np.flatnonzero(on)
            lens = e - s
            first = np.zeros(len(s), np.int64)
            np.cumsum(lens[:-1], out=first[1:])
            pos = np.arange(len(w)) - np.repeat(first, lens)
            with np.errstate(over="ignore"):
                h = np.add.reduceat(v[w].astype(np.uint64) * _powers(int(lens.max()) + 1)[pos], first)
            hs.append(mix(h + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            ss.append(s + at)
            es.append(e + at)
        at = end
    if not hs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    h, s, e = np.concatenate(hs), np.concatenate(ss), np.concatenate(es)
    return h, s, e, np.searchsorted(s, offsets)


def tidy(run: Callable) -> Callable:
    """A task's function over batches that gives freed memory back at its end.

    Python workers stay for the next tasks; what they hold on to counts
    against the executor's memory all that time.
    """

    @wraps(run)
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def tidy_group(run: Callable) -> Callable:
    """The same for a function of a whole group."""

    @wraps(run)
    def inner(group):
        try:
            return run(group)
        finally:
            give_back()

    return inner


def give_back() -> None:
    """Freed memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, text: str, most: int = 4 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``most`` bytes (one row at least)."""
    _, offsets = utf8(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, min(end, batch.num_rows) - at)
        at = end
