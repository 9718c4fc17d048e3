"""Documents packed into sequences of at most ``capacity`` tokens.

Each document's ids end with ``end_id``.  Longer documents, and only they, are cut
into pieces of ``capacity`` ids, of which the last may be shorter; every piece goes
whole into one sequence.

How to fill sequences depends on lengths alone, of which there are ``capacity``.
So the driver gets one count a length, and bin completion (``bin_completion``) turns
them into patterns: so many pieces of each of some lengths, and how many sequences
are filled so.  The pieces of a length are numbered without bringing them together:
a task numbers its own, and one row a task and length tells where its numbers begin.
A piece's number then names its pattern, sequence and place.  The patterns are bounded
by the capacity as well: two for each length, and each has at most 90 lengths (the
sum of 1 to 90 is 4095), so they go to all tasks.

A piece's numbers are stored once with it, so a lost executor can't change them.
Texts longer than a slice are encoded in parts, cut at white space.

Null and empty texts have the end id alone.  A null doc_id, or one that is no number,
is null; repeated rows are packed each by itself.  Pieces of equal length are
interchangeable, and which of them goes where is open.  An empty table gives no rows.
Other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.bin_completion import Packing, complete
from scorewell.llm.common import BLOCK_BYTES, SPACED, blank_text, slices, tidy, utf8, written
from scorewell.llm.token_file import Encoder, encoder


@dataclass(frozen=True)
class Settings:
    capacity: int = 4096
    end_id: int = 1
    #: Bounds of the search's time (see ``bin_completion``).
    nodes: int = 300
    fillings: int = 50


# --- pieces --------------------------------------------------------------------------------


def _parts(text: pa.Array, most: int) -> Iterator[pa.Array]:
    """One text in parts of about ``most`` bytes, cut at ASCII white space."""
    data, _ = utf8(text)
    at = 0
    while at < len(data):
        end = min(at + most, len(data))
        while end < len(data) and SPACED[data[end]]:
            gap = SPACED[data[end : end + most]] == 0
            end += int(np.argmax(gap)) if gap.any() else len(gap)
        yield pa.array([data[at:end].tobytes().decode()], pa.string())
        at = end


def pieces_of(coder: Encoder, text: pa.Array, s: Settings, most: int = 4 * BLOCK_BYTES) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(row, piece, start, ids) of all pieces of the texts, in order."""
    if len(text) > 1 or len(utf8(text)[0]) <= most:
        ids, n = coder.encode(text)
        ids = np.insert(ids, np.cumsum(n), s.end_id).astype("<u4")
        ends = np.cumsum(n + 1)
        for row, (end, k) in enumerate(zip(ends.tolist(), (n + 1).tolist(), strict=True)):
            mine = ids[end - k : end]
            for piece, start in enumerate(range(0, k, s.capacity)):
                yield row, piece, start, mine[start : start + s.capacity]
        return
    held, piece = np.zeros(0, "<u4"), 0
    for part in _parts(text, most):
        held = np.concatenate([held, coder.encode(part)[0].astype("<u4")])
        full = len(held) // s.capacity * s.capacity
        for at in range(0, full, s.capacity):
            yield 0, piece, piece * s.capacity, held[at : at + s.capacity]
            piece += 1
        held = held[full:]
    # The end id goes last: it may begin a piece of its own.
    yield 0, piece, piece * s.capacity, np.append(held, np.uint32(s.end_id)).astype("<u4")


def numbered(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How many pieces of the same length the task had before each; ``seen`` is moved on."""
    order = np.argsort(length, kind="stable")
    values, first, n = np.unique(length[order], return_index=True, return_counts=True)
    out = np.empty(len(length), np.int64)
    out[order] = np.arange(len(length)) - np.repeat(first, n) + np.repeat(seen[values], n)
    seen[values] += n
    return out


_FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


def pieces(docs: DataFrame, tokenizer: str, s: Settings, with_ids: bool = False) -> DataFrame:
    """All pieces, stored: each with its task and its number there among those of its length (and its ids)."""
    rows = docs.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), blank_text(F.col("text")).alias("text"))
    schema = pa.schema(_FIELDS + [("ids", pa.binary())] * with_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(s.capacity + 1, np.int64)

        def batch_of(found: list, doc_ids: pa.Array) -> pa.RecordBatch:
            row, piece, start, length, crc, ids = (list(x) for x in zip(*found))
            lengths = np.array(length, np.int64)
            columns = [doc_ids.take(pa.array(row, pa.int64())), piece, start, lengths, crc, np.full(len(row), part), numbered(lengths, seen)]
            columns = [pa.array(c, t) if not isinstance(c, pa.Array) else c for c, (_, t) in zip(columns, _FIELDS, strict=True)]
            return pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, schema=schema)

        for batch in batches:
            for some in slices(batch, "text"):
                found, held = [], 0
                for row, piece, start, ids in pieces_of(coder, some.column("text"), s):
                    raw = ids.tobytes()
                    found.append((row, piece, start, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    held += len(raw)
                    if held >= 4 * BLOCK_BYTES:
                        yield batch_of(found, some.column("doc_id"))
                        found, held = [], 0
                if found:
                    yield batch_of(found, some.column("doc_id"))

    return written(rows.mapInArrow(tidy(cut), PIECES + ", ids binary" * with_ids), "packing-pieces")


# --- places --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Slots:
    """Where the pieces of each length go: runs of ``copies`` side by side in consecutive sequences."""

    key: np.ndarray  # length << 40 | number of the run's first piece, ascending
    copies: np.ndarray
    sequence: np.ndarray  # of the run's first piece
    offset: np.ndarray

    @classmethod
    def of(cls, packing: Packing) -> Slots:
        runs, given, at = [], {}, 0
        for pattern, n in packing.bins.items():
            offset = 0
            for length, copies in pattern:
                first = given.get(length, 0)
                runs.append((length << 40 | first, copies, at, offset))
                given[length] = first + n * copies
                offset += length * copies
            at += n
        return cls(*np.array(sorted(runs), np.int64).reshape(-1, 4).T.copy())

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of these lengths and numbers."""
        key = (length << 40) + number
        run = np.searchsorted(self.key, key, "right") - 1
        inner = key - self.key[run]
        return self.sequence[run] + inner // self.copies[run], self.offset[run] + inner % self.copies[run] * length


def placed(cut: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The pieces (of ``pieces``) with sequence_id and offset."""
    s = settings or Settings()
    by_length = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_length.collect()}  # ``capacity`` rows at most
    slots = Slots.of(complete(counts, s.capacity, s.nodes, s.fillings))
    # A length has one row a task here, however many pieces it has.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    firsts = firsts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    names = [c for c in cut.columns if c not in ("part", "nth")]
    rows = cut.join(firsts, ["part", "length"]).select(*names, (F.col("first") + F.col("nth")).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = slots.places(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *map(pa.array, where)], names=[*names, "sequence_id", "offset"])

    schema = rows.drop("number").schema.add("sequence_id", "long").add("offset", "long")
    return rows.mapInArrow(tidy(place), schema)


def packed(docs: DataFrame, tokenizer: str, settings: Settings | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    s = settings or Settings()
    return placed(pieces(docs, tokenizer, s), s)


def sequences(docs: DataFrame, tokenizer: str, settings: Settings | None = None) -> DataFrame:
    """The sequences themselves: sequence_id, ids (little-endian unsigned 32-bit), and per piece doc_id, piece, offset and length.

    A sequence has ``capacity`` ids at most, so a group is as bounded.
    """
    s = settings or Settings()
    rows = placed(pieces(docs, tokenizer, s, with_ids=True), s)
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    got = rows.groupBy("sequence_id").agg(inside.alias("inside"))
    ids = F.aggregate("inside", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    spans = F.transform("inside", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["piece"].alias("piece"), x["offset"].alias("offset"), x["length"].alias("length")))
    return got.select("sequence_id", ids.alias("ids"), spans.alias("pieces"))
