"""Language-model scores from a hidden Markov model over words.

A text is its words (A-Z lower-cased, split at ASCII white space) and one end
token.  Hidden states emit words: the model has a probability for every word of the
training documents in every state, from expected counts that Baum-Welch sums across
partitions, a table with a row per word.

The states are found in two steps.  First on word classes (a hash of the word; the
end is a class of its own), whose counts are few and pass through the driver: each
iteration is a job, until the likelihood settles or ``Settings.iterations`` are done.
That model is one over words, too: a class shares its probability among its words by
their counts, in all states alike.  From it, ``Settings.word_rounds`` iterations of
Baum-Welch follow on the words themselves: tasks sum the expected counts of their
words, Spark sums those by word, and the sums are joined back to each shard's words.

A state's words are smoothed as the base is: half a count for each word and one for
all unknown ones, given to the states by their share of the tokens,
``(C[w, k] / share[k] + 0.5) / (N + 0.5 (V + 1))``; an unknown word is thus as likely
in each state as in the base, and each state's probabilities sum to 1.

For the expected counts documents are cut into segments of ``Settings.segment``
tokens that overlap by ``Settings.lap`` on each side; every token and every move
counts once, in the segment whose own part it lies in, and starts count at the
documents' starts alone.  Segments go through forward and backward in groups of
bounded size, so a text of any length takes bounded memory.  Scoring runs the scaled
forward recursion over each whole document: the sum of the logarithms of the scales
is its exact likelihood.

Texts are tokenised once, into a stored table of blocks (documents of a few
megabytes with a dictionary of their distinct words).  A file of that table is a
shard; the task that needs its words' counts reads it from the shared folder, so
only words and counts are shuffled, never the blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm import files
from scorewell.llm.common import BLOCK_BYTES, SPACED, blank_text, fold_of, slices, tidy, tidy_group, utf8, words, written


@dataclass(frozen=True)
class Settings:
    states: int = 4
    class_bits: int = 12
    #: Iterations on classes at most; fewer if a token's log10 likelihood gains less than ``settled``.
    iterations: int = 6
    settled: float = 1e-3
    #: Iterations on words after them.
    word_rounds: int = 1
    #: The start's odds of staying in a state.
    stay: float = 36.0
    segment: int = 256
    #: Tokens on each side of a segment that are looked at and not counted.
    lap: int = 8
    seed: int = 5
    #: Added to each expected count of starts, moves and classes.
    prior: float = 0.1


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes (or words) and the end x states
    #: How a segment begins that is no document's start; None: as a document does.
    cut: np.ndarray | None = None


def word_class(h: np.ndarray, s: Settings) -> np.ndarray:
    return (h >> np.uint64(64 - s.class_bits)).astype(np.int64)


# --- blocks ------------------------------------------------------------------------------------

BLOCKS = (
    "block bigint, docs int, ids binary, null_ids binary, held binary, learn binary, lens binary, "
    "tokens binary, words array<bigint>, train array<bigint>"
)
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("docs", pa.int32()), *((c, pa.binary()) for c in ("ids", "null_ids", "held", "learn", "lens", "tokens")),
     ("words", pa.list_(pa.int64())), ("train", pa.list_(pa.int64()))]
)


def make_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of (doc_id, text, held_out, learn); a text longer than a block is one by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zstd = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for rows in slices(batch, "text", 8 * BLOCK_BYTES):
                h, _, _, first = words(*utf8(rows.column("text")), SPACED)
                uniq, at, n = np.unique(h, return_inverse=True, return_counts=True)
                lens, learn = np.diff(first), rows.column("learn").to_numpy(zero_copy_only=False)
                train = np.bincount(at[np.repeat(learn, lens)], minlength=len(uniq))
                order = np.argsort(-n, kind="stable")  # frequent words get small numbers
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                planes = np.ascontiguousarray(place[at].astype("<u4").view(np.uint8).reshape(-1, 4).T)
                ids = rows.column("doc_id")
                yield pa.RecordBatch.from_pylist([{
                    "block": uuid.uuid4().int >> 65, "docs": rows.num_rows,
                    "ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                    "null_ids": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    "held": rows.column("held_out").to_numpy(zero_copy_only=False).tobytes(), "learn": learn.tobytes(),
                    "lens": lens.astype("<i8").tobytes(), "tokens": zstd.compress(planes.tobytes()),
                    "words": uniq[order].view(np.int64), "train": train[order],
                }], _BLOCKS)

    return docs.mapInArrow(tidy(run), BLOCKS)


@dataclass
class Block:
    lens: np.ndarray  # words of each document, without the end
    tokens: np.ndarray  # places in the block's dictionary, all documents one after the other
    learn: np.ndarray


def open_block(row) -> Block:
    import zstandard

    lens = np.frombuffer(row["lens"], "<i8")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["tokens"]), np.uint8)
    tokens = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
    return Block(lens, tokens, np.frombuffer(row["learn"], bool))


def with_end(classes: np.ndarray, lens: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes with an end after each document, where each document starts)."""
    return np.insert(classes, np.cumsum(lens), end), np.cumsum(lens + 1) - (lens + 1)


# --- forward and backward, many sequences side by side ----------------------------------------------


def _by_length(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequences, longest first; how many of them have a token t, for each t)."""
    order = np.argsort(-lens, kind="stable")
    return order, np.searchsorted(-lens[order], -np.arange(int(lens.max(initial=0))), "left")


def forward(m: Hmm, seq: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """log10 of each sequence's likelihood: the scaled forward recursion, step by step over all sequences."""
    out = np.zeros(len(lens))
    order, active = _by_length(lens)
    at, total, a = starts[order], np.zeros(len(lens)), None
    for t, n in enumerate(active):
        a = (m.start if a is None else a[:n] @ m.move) * m.emit[seq[at[:n] + t]]
        scale = a.sum(axis=1)
        a /= scale[:, None]
        total[:n] += np.log10(scale)
    out[order] = total
    return out


@dataclass
class Parts:
    """Sequences to count over: segments with laps."""

    starts: np.ndarray
    lens: np.ndarray
    lo: np.ndarray  # the part that counts: tokens lo to hi of the sequence
    hi: np.ndarray
    begins: np.ndarray  # is the first token a document's

    def groups(self, most: int) -> Iterator[Parts]:
        """The same in runs of about ``most`` tokens (one sequence at least)."""
        ends, at = np.cumsum(self.lens), 0
        while at < len(self.lens):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield Parts(*(x[at:end] for x in (self.starts, self.lens, self.lo, self.hi, self.begins)))
            at = end


def lapped(starts: np.ndarray, lens: np.ndarray, size: int, lap: int) -> Parts:
    """Documents in segments of ``size`` tokens, each with up to ``lap`` more on both sides."""
    at, own = segments(starts, lens, size)
    n = -(-lens // size)
    first, end = np.repeat(starts, n), np.repeat(starts + lens, n)
    low, high = np.maximum(at - lap, first), np.minimum(at + own + lap, end)
    return Parts(low, high - low, at - low, at - low + own, at == first)


def expected(m: Hmm, seq: np.ndarray, starts: np.ndarray, lens: np.ndarray, parts: Parts | None = None,
             count_as: np.ndarray | None = None, size: int | None = None) -> tuple[np.ndarray, ...]:
    """Expected counts of starts, moves and emissions, and the log10 likelihood.

    Over whole sequences, or over the counted tokens of ``parts``: with each token
    the move that leads to it.  Emissions are counted by the token, or by what
    ``count_as`` says for its place, up to ``size``.
    """
    if parts is None:
        parts = Parts(starts, lens, np.zeros_like(lens), lens, np.ones(len(lens), bool))
    count_as, size = (seq, len(m.emit)) if count_as is None else (count_as, size)
    order, active = _by_length(parts.lens)
    at, s = parts.starts[order], len(m.start)
    lo, hi, begins = parts.lo[order], parts.hi[order], parts.begins[order]
    first = m.start if m.cut is None else np.where(begins[:, None], m.start, m.cut)
    alphas, scales, a, ll = [], [], None, 0.0
    for t, n in enumerate(active):
        a = (first if a is None else a[:n] @ m.move) * m.emit[seq[at[:n] + t]]
        scale = a.sum(axis=1)
        a = a / scale[:, None]
        alphas.append(a)
        scales.append(scale)
        ll += np.log10(scale[(lo[:n] <= t) & (t < hi[:n])]).sum()
    moves, symbols, gammas = np.zeros((s, s)), [], []
    b, begun = np.zeros((0, s)), np.zeros(s)
    for t in range(len(active) - 1, -1, -1):
        n, nxt = active[t], len(b)
        here = np.ones((n, s))
        if nxt:  # b: of the sequences that go on, emission times backward over scale at t + 1
            here[:nxt] = b @ m.move.T
            counts = (lo[:nxt] <= t + 1) & (t + 1 < hi[:nxt])
            moves += alphas[t][:nxt].T @ (b * counts[:, None])
        own = (lo[:n] <= t) & (t < hi[:n])
        gamma = alphas[t] * here
        gammas.append(gamma[own])
        symbols.append(count_as[(at[:n] + t)[own]])
        if t == 0:
            begun = gamma[begins[:n]].sum(axis=0)
        b = m.emit[seq[at[:n] + t]] * here / scales[t][:, None]
    gamma, symbol = np.concatenate([*gammas, np.zeros((0, s))]), np.concatenate([*symbols, np.zeros(0, np.int64)])
    emit = np.stack([np.bincount(symbol, gamma[:, k], size) for k in range(s)], axis=1)
    return begun, moves * m.move, emit, ll


#: Tokens that go through forward and backward together.
GROUP = 1 << 19


def expected_of_documents(m: Hmm, seq: np.ndarray, starts: np.ndarray, lens: np.ndarray, s: Settings,
                          count_as: np.ndarray | None = None, size: int | None = None) -> tuple[np.ndarray, ...]:
    """``expected`` over documents cut into segments, group by group."""
    size = len(m.emit) if size is None else size
    k = len(m.start)
    total = [np.zeros(k), np.zeros((k, k)), np.zeros((size, k)), 0.0]
    for group in lapped(starts, lens, s.segment, s.lap).groups(GROUP):
        for n, x in enumerate(expected(m, seq, group.starts, group.lens, group, seq if count_as is None else count_as, size)):
            total[n] += x
    return tuple(total)


def segments(starts: np.ndarray, lens: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    n = -(-lens // size)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(starts, n) + k * size, np.minimum(size, np.repeat(lens, n) - k * size)


# --- training ------------------------------------------------------------------------------------


def initial(s: Settings) -> Hmm:
    rng = np.random.default_rng(s.seed)
    emit = rng.uniform(0.5, 1.5, ((1 << s.class_bits) + 1, s.states))
    move = np.full((s.states, s.states), 1.0) + s.stay * np.eye(s.states)
    return Hmm(np.full(s.states, 1 / s.states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _packed(start: np.ndarray, moves: np.ndarray, emit: np.ndarray, ll: float) -> np.ndarray:
    return np.concatenate([start, moves.ravel(), emit.ravel(), [ll]])


def iterate(blocks: DataFrame, m: Hmm, s: Settings) -> tuple[Hmm, float]:
    """One Baum-Welch iteration on classes: (new model, log10 likelihood of the training documents under the old one)."""
    k, end = s.states, 1 << s.class_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k + (end + 1) * k + 1)
        for batch in batches:
            for k_ in range(batch.num_rows):
                x = open_block({c: batch.column(c)[k_].as_py() for c in ("lens", "tokens", "learn")})
                if not x.learn.any():
                    continue
                classes = word_class(batch.column("words").slice(k_, 1).flatten().to_numpy().view(np.uint64), s)
                seq, starts = with_end(classes[x.tokens], x.lens, end)
                total += _packed(*expected_of_documents(m, seq, starts[x.learn], x.lens[x.learn] + 1, s))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["at", "value"])

    sums = blocks.select("lens", "tokens", "learn", "words").mapInArrow(tidy(run), "at int, value double")
    found = sums.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    total = np.zeros(k + k * k + (end + 1) * k + 1)
    total[found.column("at").to_numpy()] = found.column("value").to_numpy()
    start, moves, emit = np.split(total[:-1] + s.prior, [k, k + k * k])
    moves, emit = moves.reshape(k, k), emit.reshape(-1, k)
    shares = emit.sum(axis=0) / emit.sum()
    return Hmm(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), shares), total[-1]


def baum_welch(blocks: DataFrame, s: Settings, tokens: int = 0) -> tuple[Hmm, list[float]]:
    """The model on classes, and the likelihood before each iteration; ``tokens``: of training, to see when it settles."""
    m, history = initial(s), []
    for _ in range(s.iterations):
        m, ll = iterate(blocks, m, s)
        history.append(ll)
        if tokens and len(history) > 1 and ll - history[-2] < s.settled * tokens:
            break
    return m, history


# --- words: their counts in each state ----------------------------------------------------------------
#
# Rows of a shard (a file of the blocks): one per distinct word, with its training count
# and its expected counts in all states but the last, which has the rest; and rows without
# a word: the starts, moves, ends and likelihood by place.


def _columns(s: Settings) -> list[str]:
    return [f"c{k}" for k in range(s.states - 1)]


def _schema(s: Settings) -> str:
    return "shard int, word bigint, train bigint, " + "".join(f"{c} double, " for c in _columns(s)) + "place int, value double"


class ShardCounts:
    """The expected counts of one file's words, as its blocks come."""

    def __init__(self, s: Settings):
        self.s, self.parts, self.rest = s, [], np.zeros(2 * s.states + s.states**2 + 1)

    def add(self, words_: np.ndarray, train: np.ndarray, counts: np.ndarray | None, stats: np.ndarray | None) -> None:
        none = np.zeros((len(words_), self.s.states - 1), np.float32)
        self.parts.append((words_, train, none if counts is None else counts[:, :-1].astype(np.float32)))
        if stats is not None:
            self.rest += stats
        if len(self.parts) == 16:
            self.parts = [self.merged()]

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words_, train, counts = (np.concatenate(x) for x in zip(*self.parts))
        if not len(words_):
            return words_, train, counts
        order = np.argsort(words_, kind="stable")
        words_ = words_[order]
        first = np.flatnonzero(np.concatenate([[True], words_[1:] != words_[:-1]]))
        return words_[first], np.add.reduceat(train[order], first), np.add.reduceat(counts[order], first, axis=0)

    def batches(self, shard: int) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("shard", pa.int32()), ("word", pa.int64()), ("train", pa.int64()), *((c, pa.float64()) for c in _columns(self.s)),
             ("place", pa.int32()), ("value", pa.float64())]
        )
        yield pa.RecordBatch.from_pylist([{"shard": shard, "place": k, "value": v} for k, v in enumerate(self.rest.tolist()) if v], schema)
        words_, train, counts = self.merged()
        for k in range(0, len(words_), 1 << 16):
            end = min(k + (1 << 16), len(words_))
            nulls = [pa.nulls(end - k, schema.field(c).type) for c in ("place", "value")]
            cols = [pa.array(counts[k:end, c].astype(np.float64)) for c in range(counts.shape[1])]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(end - k, shard, np.int32)), pa.array(words_[k:end]), pa.array(train[k:end]), *cols, *nulls], schema=schema)


def _stats(start: np.ndarray, moves: np.ndarray, emit: np.ndarray, ll: float) -> np.ndarray:
    """Starts, moves, ends by state, and the likelihood."""
    return np.concatenate([start, moves.ravel(), emit[-1], [ll]])


def shard_files(blocks: DataFrame) -> list[str]:
    """The files of the blocks; a shard's number is its place here.  One name for each task that wrote blocks."""
    return sorted(r[0] for r in blocks.select(F.input_file_name()).distinct().collect())


def class_counts(blocks: DataFrame, shards: list[str], m: Hmm, s: Settings) -> DataFrame:
    """The shards' words with their expected counts under the model on classes."""
    end, number = 1 << s.class_bits, {file: k for k, file in enumerate(shards)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("lens", "tokens", "learn", "file")}
                if held is not None and at != number[row["file"]]:
                    yield from held.batches(at)
                    held = None
                held, at = held or ShardCounts(s), number[row["file"]]
                words_, train = (batch.column(c).slice(k, 1).flatten().to_numpy() for c in ("words", "train"))
                x = open_block(row)
                counts = stats = None
                if x.learn.any():
                    classes = word_class(words_.view(np.uint64), s)
                    seq, starts = with_end(classes[x.tokens], x.lens, end)
                    places, _ = with_end(x.tokens.astype(np.int64), x.lens, len(words_))
                    start, moves, emit, ll = expected_of_documents(m, seq, starts[x.learn], x.lens[x.learn] + 1, s, places, len(words_) + 1)
                    counts, stats = emit[:-1], _stats(start, moves, emit, ll)
                held.add(words_, train, counts, stats)
        if held is not None:
            yield from held.batches(at)

    rows = blocks.select("lens", "tokens", "learn", "words", "train", F.input_file_name().alias("file"))
    return rows.mapInArrow(tidy(run), _schema(s))


@dataclass
class WordModel:
    """Starts, moves and what the words' probabilities need besides their counts."""

    start: np.ndarray
    move: np.ndarray
    shares: np.ndarray  # of the tokens, by state
    n: int  # training tokens, ends included
    v: int  # distinct ones
    ends: np.ndarray  # expected counts of the end, by state
    n_ends: int

    def emissions(self, train: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Words (and, last, the end) x states, from their counts and the expected counts in all states but the last."""
        full = np.concatenate([counts, np.maximum(train - counts.sum(axis=1), 0)[:, None]], axis=1)
        full = np.concatenate([full, self.ends[None]])
        return (full / self.shares + 0.5) / (self.n + 0.5 * (self.v + 1))

    def base(self, train: np.ndarray) -> np.ndarray:
        return np.log10((train + 0.5) / (self.n + 0.5 * (self.v + 1)))


def word_model(counted: DataFrame, totals: DataFrame, n_ends: int, s: Settings) -> tuple[WordModel, float]:
    """The model's numbers from the stored counts, and the likelihood that they were counted under.

    The driver gets the sums over all words and 2 ``states`` + ``states``^2 + 1 numbers.
    """
    k, cols = s.states, _columns(s)
    stats = np.zeros(2 * k + k * k + 1)
    for r in counted.where("place IS NOT NULL").groupBy("place").agg(F.sum("value").alias("value")).collect():
        stats[r["place"]] = r["value"]
    sums = totals.agg(F.sum("train").alias("train"), F.count_if(F.col("train") > 0).alias("v"), *[F.sum(c).alias(c) for c in cols]).first()
    n_words = sums["train"] or 0
    per_state = np.array([sums[c] or 0.0 for c in cols])
    per_state = np.append(per_state, max(n_words - per_state.sum(), 0.0))
    start, moves, ends = stats[:k], stats[k : k + k * k].reshape(k, k), stats[k + k * k : -1]
    shares = (per_state + ends + s.prior) / (per_state + ends + s.prior).sum()
    start, moves = start + s.prior, moves + s.prior
    m = WordModel(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), shares, n_words + n_ends, sums["v"] + (n_ends > 0), ends, n_ends)
    return m, float(stats[-1])


def joined(counted: DataFrame, totals: DataFrame, n_shards: int) -> DataFrame:
    """Each shard's words with their counts in the whole corpus, a partition a shard.

    A common word has one row a shard; the join may split them, as Spark sees fit.
    A shard without any word has a row of nulls.
    """
    mine = counted.where("word IS NOT NULL").select("shard", "word").join(totals, "word")
    every = counted.sparkSession.range(n_shards).select(F.col("id").cast("int").alias("shard"))
    rows = mine.select("shard", *totals.columns).unionByName(every, allowMissingColumns=True)
    return rows.repartitionById(max(1, n_shards), "shard")


@dataclass
class ShardWords:
    """A shard's words in order, with their probabilities."""

    words: np.ndarray
    train: np.ndarray
    emit: np.ndarray

    @classmethod
    def of(cls, group: pa.Table, m: WordModel, s: Settings) -> ShardWords:
        rows = group.filter(pc.is_valid(group.column("word")))
        order = np.argsort(rows.column("word").to_numpy(), kind="stable")
        words_, train = (rows.column(c).to_numpy()[order] for c in ("word", "train"))
        # A file that two tasks read has a word twice, with the same sums.
        once = np.concatenate([[True], words_[1:] != words_[:-1]])[: len(words_)]
        counts = np.stack([rows.column(c).to_numpy()[order] for c in _columns(s)], axis=1)[once] if s.states > 1 else np.zeros((int(once.sum()), 0))
        return cls(words_[once], train[once], m.emissions(train[once], counts))

    def places(self, words_: np.ndarray) -> np.ndarray:
        """Where a block's words are; the end of a text is at the last place of ``emit``."""
        return np.searchsorted(self.words, words_)


def blocks_of(file: str) -> Iterator[dict]:
    """The blocks of a stored file, one at a time."""
    with files.open_input(file) as source:
        for batch in pq.ParquetFile(source).iter_batches(batch_size=1):
            row = batch.drop_columns(["words", "train"]).to_pylist()[0]
            yield row | {"words": batch.column("words").flatten().to_numpy()}


def word_counts(rows: DataFrame, shards: list[str], m: WordModel, s: Settings) -> DataFrame:
    """The shards' words with their expected counts under the model on words."""

    def run(group: pa.Table) -> pa.Table:
        mine, held, shard = ShardWords.of(group, m, s), ShardCounts(s), group.column("shard")[0].as_py()
        model, end = Hmm(m.start, m.move, mine.emit, m.shares), len(mine.words)
        for row in blocks_of(shards[shard]):
            x, own = open_block(row), mine.places(row["words"])
            train = np.bincount(own[x.tokens[np.repeat(x.learn, x.lens)]], minlength=end)
            counts = stats = None
            if x.learn.any():
                seq, starts = with_end(own[x.tokens], x.lens, end)
                start, moves, emit, ll = expected_of_documents(model, seq, starts[x.learn], x.lens[x.learn] + 1, s)
                counts, stats = emit[:-1], _stats(start, moves, emit, ll)
            held.add(mine.words, train, counts, stats)
        return pa.Table.from_batches([*held.batches(shard)])

    return rows.groupBy("shard").applyInArrow(tidy_group(run), _schema(s))


# --- scoring ---------------------------------------------------------------------------------------

RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def block_scores(row: dict, mine: ShardWords, m: WordModel) -> pa.RecordBatch:
    x, own = open_block(row), mine.places(row["words"])
    end = len(mine.words)
    before = np.concatenate([[0], np.cumsum(x.lens)])
    known = np.concatenate([[0], np.cumsum((mine.train > 0)[own][x.tokens])])
    exact = np.add.reduceat(np.append(m.base(mine.train)[own][x.tokens], 0.0), before[:-1]) * (x.lens > 0)
    seq, starts = with_end(own[x.tokens], x.lens, end)
    model = Hmm(m.start, m.move, mine.emit)
    null = np.frombuffer(row["null_ids"], bool)
    columns = [
        pa.array(np.frombuffer(row["ids"], "<i8"), mask=null), pa.array(np.frombuffer(row["held"], bool)), pa.array(x.lens + 1),
        pa.array(np.diff(known[before]) + (m.n_ends > 0)), pa.array(np.full(len(x.lens), m.n)),
        pa.array(exact + m.base(np.array([m.n_ends]))[0]), pa.array(np.minimum(forward(model, seq, starts, x.lens + 1), 0.0)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])


def trained(blocks: DataFrame, shards: list[str], n_ends: int, s: Settings) -> tuple[WordModel, DataFrame, list[float]]:
    """(the model, each shard's words with their counts, log10 likelihoods of the training documents
    before each iteration on classes and then under the model that each iteration on words began with)."""
    tokens = n_ends + (blocks.select(F.sum(F.aggregate("train", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0)
    m, history = baum_welch(blocks, s, tokens)
    counted = written(class_counts(blocks, shards, m, s), "hmm-counts")
    for k in range(max(1, s.word_rounds)):
        sums = [F.sum(c).alias(c) for c in ("train", *_columns(s))]
        totals = written(counted.where("word IS NOT NULL").groupBy("word").agg(*sums), "hmm-totals")
        found, ll = word_model(counted, totals, n_ends, s)
        history.append(ll)
        rows = joined(counted, totals, len(shards))
        if k + 1 < s.word_rounds:
            counted = written(word_counts(rows, shards, found, s), "hmm-counts")
    return found, rows, history


def score(docs: DataFrame, learn: Column, held_out: Column, settings: Settings | None = None) -> DataFrame:
    """Base and model scores of all documents (doc_id, text); the model learns where ``learn`` is true.

    Null and empty texts are the end token alone.  Without training documents
    N and V are 0 and every token has probability 1.  A doc_id that is no number is
    null; rows with equal ids are scored each; other columns play no part.
    """
    s = settings or Settings()
    rows = docs.select(
        F.col("doc_id").try_cast("bigint").alias("doc_id"), blank_text(F.col("text")).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    blocks = written(make_blocks(rows), "hmm-blocks")
    shards = shard_files(blocks)
    m, words_, _ = trained(blocks, shards, rows.where("learn").count(), s)

    def run(group: pa.Table) -> pa.Table:
        mine, file = ShardWords.of(group, m, s), shards[group.column("shard")[0].as_py()]
        return pa.Table.from_batches([block_scores(row, mine, m) for row in blocks_of(file)])

    return words_.groupBy("shard").applyInArrow(tidy_group(run), RESULT)


def score_table(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Scores of all documents, learning from those whose crc32(doc_id as text) mod 5 isn't 1.

    A null id is neither held out nor learned from.
    """
    fold = fold_of(F.col("doc_id"), 5)
    return score(docs, fold != 1, fold == 1, settings)
