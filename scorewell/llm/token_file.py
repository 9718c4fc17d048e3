"""Token ids of documents in byte-plane files.

A file holds the ids of consecutive documents as chunks of ``CHUNK`` ids.  A
chunk's ids, unsigned 32-bit, are transposed into four byte planes (all lowest
bytes, then all second bytes, and so on), and each plane is compressed with
zstandard by itself: planes of equal or similar bytes shrink to almost nothing.

File layout (numbers little-endian)::

    magic "BYTEPLN1"
    chunks: the four compressed planes of each, one after the other
    index, compressed: chunks (int64 offset, int64 ids, 4 x int64 plane length, int64 crc32)
                       documents (int64 doc_id, int64 ids, int64 1 if doc_id is null)
    footer: int64 offset of the index, int64 chunks, int64 documents, magic

The chunk index makes any range of ids readable alone.  The manifest, a table
with one row per file, gives each file's documents and ids, and so where it
starts among all ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.llm import files
from scorewell.llm.common import SPACED, blank_text, slices, tidy, utf8, words, written
from scorewell.session import scratch_location

CHUNK = 1 << 16
MAGIC = b"BYTEPLN1"
FOOTER = struct.Struct("<qqq8s")
#: Appended to each document.
END_ID = 2
#: Words whose ids a worker remembers.
CACHE_WORDS = 1_000_000
#: Characters of a text that order the rows of one id.
SPLIT = 32

# --- encoding ------------------------------------------------------------------------------

#: A run of letters, all of whose lower cases are single characters that don't depend on
#: their neighbours, and a full stop or comma after it: two pre-tokens.
_STOPPED = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+[.,]")
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")


def _gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces flat[start : start + length], one after the other."""
    before = np.cumsum(length) - length
    return flat[np.repeat(start - before, length) + np.arange(int(length.sum()))]


class Encoder:
    """Ids of texts, as the tokenizer gives for the whole text.

    The tokenizer splits at white space before anything else, so a text's ids
    are those of its words one after the other; each distinct word is encoded
    by the library once while it stays in the cache.  The tokenizer ignores
    case, so words that differ in the case of A-Z are one, except where a
    special token may stand (words with a ``<``).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.stops = {c: self._one(c) for c in ".,"}
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes, sorted
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _one(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of runs of letters: one pre-token each, so that one
        id of each ends a word and many can be encoded as one text."""
        texts = [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            each = [self._one(w) for w in words]
            return np.array([*chain.from_iterable(each)], np.uint32), np.array([len(x) for x in each], np.int64)
        return ids, np.diff(ends, prepend=0)

    def _add(self, hashes: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Adds pieces under hashes that aren't in the cache."""
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.start = np.insert(self.start, at, (len(self.flat) + np.cumsum(n) - n)[order])
        self.length = np.insert(self.length, at, n[order])
        self.known = np.insert(self.known, at, hashes[order])
        self.flat = np.concatenate([self.flat, ids])

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """Adds words that aren't in the cache, each once."""
        plain, stopped, odd = [], [], []
        for k, w in enumerate(texts):
            (plain if _PLAIN.fullmatch(w) else stopped if _STOPPED.fullmatch(w) else odd).append(k)
        stems = [texts[k] for k in plain] + [texts[k][:-1] for k in stopped]
        if stems:
            h = words(*utf8(pa.array(stems)), SPACED)[0]
            uniq, where = np.unique(h, return_index=True)
            new = ~np.isin(uniq, self.known, assume_unique=True)
            if new.any():
                self._add(uniq[new], *self._letters([stems[k] for k in where[new].tolist()]))
        if stopped:
            at = np.searchsorted(self.known, h[len(plain) :])
            comma = np.array([texts[k][-1] == "," for k in stopped])
            n_stop = np.where(comma, len(self.stops[","]), len(self.stops["."]))
            flat = np.concatenate([self.flat, np.array([*self.stops["."], *self.stops[","]], np.uint32)])
            stop_at = len(self.flat) + np.where(comma, len(self.stops["."]), 0)
            start, n = np.stack([self.start[at], stop_at], axis=1), np.stack([self.length[at], n_stop], axis=1)
            self._add(hashes[stopped], _gather(flat, start.ravel(), n.ravel()), n.sum(axis=1))
        if odd:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast([texts[k] for k in odd], add_special_tokens=False)]
            self._add(hashes[odd], np.array([*chain.from_iterable(ids)], np.uint32), np.array([len(x) for x in ids], np.int64))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        data, offsets = utf8(column)
        h, s, e, first = words(data, offsets, SPACED)
        for at in np.flatnonzero(data == 60):  # <
            k = int(np.searchsorted(s, at, "right")) - 1
            h[k] = int.from_bytes(blake2b(data[s[k] : e[k]].tobytes(), digest_size=8).digest(), "big")
        if len(self.known) > CACHE_WORDS:
            self.clear()
        uniq, where, at = np.unique(h, return_index=True, return_inverse=True)
        new = ~np.isin(uniq, self.known, assume_unique=True)
        if new.any():
            raw = data.tobytes()
            self._learn(uniq[new], [raw[s[k] : e[k]].decode() for k in where[new].tolist()])
        place = np.searchsorted(self.known, uniq)[at]
        lens = self.length[place]
        sums = np.concatenate([[0], np.cumsum(lens)])
        return _gather(self.flat, self.start[place], lens), np.diff(sums[first])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- files ---------------------------------------------------------------------------------


class Writer:
    """Writes one file; holds one chunk of ids and the index."""

    def __init__(self, out, chunk: int = CHUNK):
        import zstandard

        self.out, self.chunk = out, chunk
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.out.write(MAGIC)
        self.at, self.held, self.n_held = len(MAGIC), [], 0
        self.chunks: list[list[int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, n: int) -> None:
        self.docs.append((doc_id or 0, n, int(doc_id is None)))

    def ids(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.chunk:
            every = np.concatenate(self.held)
            full = len(every) // self.chunk * self.chunk
            for k in range(0, full, self.chunk):
                self._flush(every[k : k + self.chunk])
            self.held, self.n_held = [every[full:]], len(every) - full

    def _flush(self, ids: np.ndarray) -> None:
        raw = np.ascontiguousarray(ids, "<u4")
        planes = [self.zstd.compress(np.ascontiguousarray(p)) for p in raw.view(np.uint8).reshape(-1, 4).T]
        self.chunks.append([self.at, len(ids), *map(len, planes), zlib.crc32(raw)])
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> int:
        """Ends the file; returns the number of ids."""
        if self.n_held:
            self._flush(np.concatenate(self.held))
        index = np.array([x for c in self.chunks for x in c] + [x for d in self.docs for x in d], "<i8")
        self.out.write(self.zstd.compress(index.tobytes()))
        self.out.write(FOOTER.pack(self.at, len(self.chunks), len(self.docs), MAGIC))
        self.out.close()
        return sum(c[1] for c in self.chunks)


class Reader:
    def __init__(self, uri: str):
        import zstandard

        self.zstd, self.file = zstandard.ZstdDecompressor(), files.open_input(uri)
        size = self.file.size()
        at, n, docs, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no byte-plane file")
        index = np.frombuffer(self.zstd.decompress(self._read(at, size - FOOTER.size - at)), "<i8")
        self.chunks, self.docs = index[: 7 * n].reshape(n, 7), index[7 * n :].reshape(docs, 3)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def chunk(self, k: int) -> np.ndarray:
        at, n, *lens, crc = (int(x) for x in self.chunks[k])
        data, planes = self._read(at, sum(lens)), []
        for length in lens:
            planes.append(np.frombuffer(self.zstd.decompress(data[:length], max_output_size=n), np.uint8))
            data = data[length:]
        ids = np.ascontiguousarray(np.stack(planes, axis=1)).view("<u4").ravel()
        if zlib.crc32(ids) != crc:
            raise ValueError(f"chunk {k} is damaged")
        return ids

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """(doc_id, number of ids, the ids as pieces of chunks), in order; one chunk at a time."""
        k, ids = -1, np.zeros(0, "<u4")
        for doc_id, n, null in self.docs.tolist():
            pieces, left = [], n
            while left:
                if not len(ids):
                    k += 1
                    ids = self.chunk(k)
                pieces.append(ids[:left])
                ids, left = ids[left:], left - len(pieces[-1])
            yield None if null else doc_id, n, pieces


MANIFEST = "file string, first_id bigint, part int, docs bigint, ids bigint"


def write_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Writes (doc_id, text) in ascending order of doc_id, a file per partition; returns the manifest.

    Null ids come first, and an id that is no number is null; rows with the same id
    are ordered by the first ``SPLIT`` characters of their texts, then by hash, then
    by text; a null text has the end id alone.  Partitions without rows have no file.
    The ranges may part the rows of one id, also equal ones, so an id that a third of
    all rows share, or null, is written by many tasks.
    """
    rows = docs.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), blank_text(F.col("text")).alias("text"))
    order = ["doc_id", F.substring("text", 1, SPLIT), F.xxhash64("text")]
    # Equal rows go by where they come from; which of them is first makes no difference.
    rows = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, first, coder, part = None, None, encoder(tokenizer), TaskContext.get().partitionId()
        for batch in batches:
            for rows in slices(batch, "text") if batch.num_rows else ():
                ids, lens = coder.encode(rows.column("text"))
                with_end = np.insert(ids, np.cumsum(lens), end_id)
                if out is None:
                    uri, stream = files.create(folder, f"part-{part:06d}")
                    out, first = Writer(stream), rows.column("doc_id")[0].as_py()
                for doc_id, n in zip(rows.column("doc_id").to_pylist(), lens.tolist(), strict=True):
                    out.add(doc_id, n + 1)
                out.ids(with_end)
        if out is not None:
            row = {"file": uri, "first_id": first, "part": part, "docs": len(out.docs), "ids": out.close()}
            yield pa.RecordBatch.from_pylist([row], MANIFEST_ARROW)

    return written(rows.mapInArrow(tidy(write), MANIFEST), "token-manifest")


MANIFEST_ARROW = pa.schema(
    [("file", pa.string()), ("first_id", pa.int64()), ("part", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64())]
)
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
ROWS_ARROW = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])


def read_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """From the files: doc_id, start, n_tokens and the crc32 of the ids as little-endian uint32.

    The driver sums up one number per file; ids never pass through it.
    """
    at, found = 0, []
    for r in sorted(manifest.collect(), key=lambda r: r["part"]):
        found.append((r["file"], at))
        at += r["ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                start, cols = row["start"], ([], [], [], [])
                for doc_id, n, pieces in Reader(row["file"]).documents():
                    crc = 0
                    for p in pieces:
                        crc = zlib.crc32(np.ascontiguousarray(p), crc)
                    for col, x in zip(cols, (doc_id, start, n, crc), strict=True):
                        col.append(x)
                    start += n
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=ROWS_ARROW)

    names = spark.createDataFrame(found, "file string, start bigint").repartition(max(1, len(found)))
    return names.mapInArrow(tidy(read), ROWS)


def token_table(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the documents' ids to ``folder`` (a fresh shared one by default) and reads them back.

    One row per document; other columns of ``docs`` play no part.  An empty
    table writes no file and gives no rows.
    """
    spark = docs.sparkSession
    folder = scratch_location(spark, "token-files") if folder is None else folder
    return read_files(spark, write_files(docs, tokenizer, folder, end_id))
