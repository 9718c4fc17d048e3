"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns give the base spans.  The field reads each line as a sequence of
words and tags every word as O (outside), B (a secret begins) or I (it goes
on), from the word's shape, its neighbours and features of the whole file;
Viterbi finds the best tags.  It is trained here, by maximum likelihood with an
L2 penalty, on windows of at most ``Settings.window`` words from a sample of
documents labelled by the base spans (in expectation ``Settings.sample`` with a
span and as many without, or all there are): it
learns what the words inside such spans look like and where they stand, and so
tags secrets in forms that the patterns don't name.

A line all of whose words speak so clearly for O that no transition could
outweigh it is O throughout and skips the recursion; that test is exact.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import BLOCK_BYTES, SPACED, blank_text, mix, removed, slices, stored, tidy, utf8, words

# --- base spans ----------------------------------------------------------------------------

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ with 24 or more
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "crf")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key", "key", "pwd", "auth", "bearer", "credential")


@dataclass(frozen=True, order=True)
class Span:
    start: int
    kind: int  # place in KINDS
    end: int
    secret: int  # where the secret itself starts


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that don't overlap, short ones dropped; in code points."""
    found = [Span(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [Span(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [Span(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True


def with_base(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Numbers of the texts that may have base spans; no other text has any."""
    raw, found = data.tobytes(), []
    for gate, where in ((raw.lower(), (b"passw", b"secret", b"token", b"api")), (raw, (b"AKIA",))):
        for word in where:
            at = gate.find(word)
            while at >= 0:
                k = int(np.searchsorted(offsets, at, "right")) - 1
                found.append(k)
                at = gate.find(word, int(offsets[k + 1]))
    for k in range(0, len(data), BLOCK_BYTES):  # runs of hex digits; one that crosses two blocks shows in the overlap
        on = _HEX[data[k : k + BLOCK_BYTES + 64]]
        cut = np.zeros(len(on) + 1, bool)  # a document begins here
        cut[offsets[np.searchsorted(offsets, k) : np.searchsorted(offsets, k + len(on))] - k] = True
        starts = np.flatnonzero(on & (~np.concatenate([[False], on[:-1]]) | cut[:-1]))
        ends = np.flatnonzero(on & (~np.concatenate([on[1:], [False]]) | cut[1:])) + 1
        starts = starts[ends - starts >= 24]
        found += (np.searchsorted(offsets, starts + k, "right") - 1).tolist()
    return np.unique(np.array(found, np.int64))


# --- features of words ------------------------------------------------------------------------

O, B, I = 0, 1, 2  # noqa: E741
SIZES = np.array([256, 40, 2, 8, 8, 8, 8, 256, 256])
STARTS = np.cumsum(SIZES) - SIZES

_FLAGS = np.zeros(256, np.uint8)
for _c in range(256):
    _ch = chr(_c)
    _FLAGS[_c] = (
        1 if _ch.isdigit() and _c < 128 else 2 if "a" <= _ch <= "z" else 4 if "A" <= _ch <= "Z" else 8 if _c >= 128
        else 16 if _ch in "=:" else 32 if _ch in "\"'`" else 64 if _ch in "+/_-" else 128 if _c > 32 else 0
    )


def _hashes(texts: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(texts))
    return np.sort(words(data, offsets, SPACED)[0])


_NAMES = _hashes([a + n + b for n in NAMES for a in ("", '"', "'") for b in ("", ":", "=", '":', "':", '"', "'")])
_SIGNS = _hashes(["=", ":", "=>", ":=", "->"])


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


@dataclass
class Words:
    start: np.ndarray  # bytes
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # does a line begin here
    features: np.ndarray  # words x kinds of features, places in the weights


def _shift(x: np.ndarray, first: np.ndarray, back: int) -> np.ndarray:
    """The value of the word before (back = 1) or after (-1) in the same line, else 0."""
    out = np.zeros_like(x)
    if back == 1:
        out[1:] = np.where(first[1:], 0, x[:-1])
    else:
        out[:-1] = np.where(first[1:], 0, x[1:])
    return out


def describe(data: np.ndarray, offsets: np.ndarray) -> Words:
    h, s, e, before = words(data, offsets, SPACED)
    n = len(h)
    if not n:
        return Words(s, e, s, np.zeros(0, bool), np.zeros((0, len(SIZES)), np.int32))
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    line = lines[s]
    first = np.ones(n, bool)
    first[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    flags = np.bitwise_or.reduceat(_FLAGS[data], s)
    digit = np.add.reduceat(_FLAGS[data] == 1, s, dtype=np.int32)
    hexes = np.add.reduceat(_HEX[data], s, dtype=np.int32)
    size = (e - s).astype(np.int32)
    core = size - ((flags & 32) > 0) * 2
    long = np.searchsorted([4, 8, 12, 16, 20, 24, 40], size, "right")
    share = np.where(digit == 0, 0, np.where(digit == size, 4, 1 + (digit * 5 > size) + (digit * 2 > size)))
    name, sign = _among(h, _NAMES).astype(np.int32), _among(h, _SIGNS).astype(np.int32)
    sign |= _shift_end(data, e)
    prev_name = _shift(name, first, 1)
    some = np.zeros(len(offsets) - 1, np.int32)
    np.maximum.at(some, doc[name > 0], 1)
    digits = np.bincount(doc, digit, len(some)) / np.maximum(np.diff(offsets), 1)
    file = some + 2 * np.searchsorted([0.005, 0.02, 0.1], digits)
    low = (flags & 7).astype(np.int32)
    hashed = (h >> np.uint64(56)).astype(np.int32)
    f = np.stack([
        flags.astype(np.int32), long * 5 + share, ((hexes >= core) & (core >= 16)).astype(np.int32),
        prev_name + 2 * _shift(sign, first, 1) + 4 * _shift(prev_name, first, 1),
        _shift(low, first, -1), file[doc], _shift(low, first, 1), _shift(hashed, first, 1), _shift(hashed, first, -1),
    ], axis=1)
    return Words(s, e, doc, first, (f + STARTS).astype(np.int32))


def _shift_end(data: np.ndarray, e: np.ndarray) -> np.ndarray:
    """1 for words that end with an equals sign or a colon."""
    last = data[e - 1]
    return ((last == 61) | (last == 58)).astype(np.int32)


# --- the field ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    #: Documents with a base span in the sample, and documents without, in expectation; of windows without a secret, one in so many is used.
    sample: int = 4000
    #: Windows that the field is fitted on at most, in expectation: long documents have many.
    windows: int = 65_536
    window: int = 64
    thin: int = 16
    steps: int = 80
    rate: float = 0.2
    l2: float = 1e-5
    #: Least bytes of an added secret.
    least: int = 8


@dataclass
class Field:
    weights: np.ndarray  # places x tags
    moves: np.ndarray  # from x to, -inf where forbidden
    begin: np.ndarray


FORBIDDEN = np.array([[0, 0, -np.inf], [0, 0, 0], [0, 0, 0]])


def _layout(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-lens, kind="stable")
    return order, np.searchsorted(-lens[order], -np.arange(int(lens.max(initial=0))), "left")


def likelihood(x: np.ndarray, starts: np.ndarray, lens: np.ndarray, m: Field) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(sum of log normalisers, tag marginals of words, expected moves, expected first tags)."""
    top = x.max(axis=1, keepdims=True)
    pot, move, begin = np.exp(x - top), np.exp(m.moves), np.exp(m.begin)
    order, active = _layout(lens)
    at, alphas, scales, a = starts[order], [], [], None
    for t, n in enumerate(active):
        a = (begin if a is None else a[:n] @ move) * pot[at[:n] + t]
        scale = a.sum(axis=1, keepdims=True)
        a = a / scale
        alphas.append(a)
        scales.append(scale)
    z = float(sum(np.log(s).sum() for s in scales) + top.sum())
    marginal, moves, b = np.zeros_like(x), np.zeros((3, 3)), np.zeros((0, 3))
    for t in range(len(active) - 1, -1, -1):
        n, nxt = active[t], len(b)
        here = np.ones((n, 3))
        if nxt:
            here[:nxt] = b @ move.T
            moves += alphas[t][:nxt].T @ b
        marginal[at[:n] + t] = alphas[t] * here
        b = pot[at[:n] + t] * here / scales[t]
    return z, marginal, moves * move, marginal[starts].sum(axis=0)


def fit(features: np.ndarray, tags: np.ndarray, lens: np.ndarray, s: Settings) -> Field:
    """Maximum likelihood by Adam over all windows at once."""
    starts = np.cumsum(lens) - lens
    size = int(SIZES.sum())
    theta = np.zeros(size * 3 + 9 + 3)
    inner = np.ones(len(tags), bool)
    inner[starts] = False
    seen = np.zeros((3, 3))
    np.add.at(seen, (tags[:-1][inner[1:]], tags[1:][inner[1:]]), 1)
    seen_first = np.bincount(tags[starts], minlength=3)
    gold = np.zeros((len(tags), 3))
    gold[np.arange(len(tags)), tags] = 1
    first, second = np.zeros_like(theta), np.zeros_like(theta)

    def field() -> Field:
        begin = theta[-3:].copy()
        begin[I] = -np.inf
        return Field(theta[: size * 3].reshape(size, 3), theta[size * 3 : -3].reshape(3, 3) + FORBIDDEN, begin)

    for step in range(1, s.steps + 1):
        m = field()
        _, marginal, moves, begins = likelihood(m.weights[features].sum(axis=1), starts, lens, m)
        diff, g = marginal - gold, np.zeros((size, 3))
        for k in range(3):
            for j in range(features.shape[1]):
                g[:, k] += np.bincount(features[:, j], diff[:, k], size)
        grad = np.concatenate([g.ravel(), (moves - seen).ravel(), begins - seen_first]) / len(lens) + s.l2 * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        theta = theta - s.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return field()


def viterbi(x: np.ndarray, starts: np.ndarray, lens: np.ndarray, m: Field) -> np.ndarray:
    """The best tags of all words; ties go to the tag that comes first."""
    tags = np.zeros(len(x), np.int8)
    order, active = _layout(lens)
    at, backs, v, ends = starts[order], [], None, np.zeros((len(lens), 3))
    for t, n in enumerate(active):
        if v is None:
            v = m.begin + x[at[:n]]
        else:
            through = v[:n, :, None] + m.moves[None]
            backs.append(through.argmax(axis=1).astype(np.int8))
            v = through.max(axis=1) + x[at[:n] + t]
        ends[:n] = v
    best = ends.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        tags[at[:n] + t] = best[:n]
        if t:
            best[:n] = backs[t - 1][np.arange(n), best[:n]]
    return tags


def decode(w: Words, m: Field) -> np.ndarray:
    """Tags of all words, line by line."""
    tags = np.zeros(len(w.start), np.int8)
    if not len(tags):
        return tags
    x = np.zeros((len(tags), 3))
    for j in range(w.features.shape[1]):
        x += m.weights[w.features[:, j]]
    allowed = np.concatenate([m.moves[np.isfinite(m.moves)], m.begin[np.isfinite(m.begin)], [0.0]])
    # A run of n tags that aren't O has at most n + 1 <= 2n transitions that may gain by it.
    open_ = x[:, O] - x[:, 1:].max(axis=1) <= 2 * (allowed.max() - allowed.min())
    starts = np.flatnonzero(w.first)
    lens = np.diff(np.append(starts, len(tags)))
    some = np.add.reduceat(open_, starts, dtype=np.int64) > 0
    if some.any():
        found = viterbi(x, starts[some], lens[some], m)
        tags |= found
    return tags


def tagged_spans(data: np.ndarray, w: Words, tags: np.ndarray, least: int) -> dict[int, list[tuple[int, int]]]:
    """By document: byte spans of the words tagged B I*, without punctuation around them."""
    out: dict[int, list[tuple[int, int]]] = {}
    for k in np.flatnonzero(tags == B):
        last = k
        while last + 1 < len(tags) and tags[last + 1] == I and not w.first[last + 1]:
            last += 1
        s, e = int(w.start[k]), int(w.end[last])
        while s < e and _FLAGS[data[s]] & 0xB0:
            s += 1
        while s < e and _FLAGS[data[e - 1]] & 0xB0:
            e -= 1
        if e - s >= least:
            out.setdefault(int(w.doc[k]), []).append((s, e))
    return out


# --- training on a sample, scanning of all ------------------------------------------------------------


def code_points(data: np.ndarray) -> np.ndarray:
    """How many code points of a text begin before each of its bytes, and before its end."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def _gold(text: str, data: np.ndarray, w: Words, rows: np.ndarray, offset: int) -> np.ndarray:
    """Tags of a document's words (in order, apart) by its base spans; ``data`` is the text's bytes."""
    tags = np.zeros(len(rows), np.int64)
    begin, end = w.start[rows] - offset, w.end[rows] - offset
    at = code_points(data)
    for s in base_spans(text):
        a, b = np.searchsorted(at, (s.secret, s.end), "right") - 1  # the byte that a code point begins at
        first, last = int(np.searchsorted(end, a, "right")), int(np.searchsorted(begin, b, "left"))
        if first < last and not tags[first:last].any():
            tags[first:last] = I
            tags[first] = B
    return tags


class Covered:
    """Which stretches of a text its base spans touch."""

    def __init__(self, spans: list[Span]):
        self.starts = [s.start for s in spans]  # sorted, as base_spans gives them
        self.ends = np.maximum.accumulate([s.end for s in spans]).tolist() if spans else []

    def touches(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.ends[k - 1] > a


def with_spans(column: pa.Array) -> np.ndarray:
    """Which of the texts have base spans."""
    out = np.zeros(len(column), bool)
    for k in with_base(*utf8(column)).tolist():
        out[k] = bool(base_spans(column[k].as_py()))
    return out


def sizes(docs: DataFrame) -> tuple[int, int]:
    """Documents without a base span, and with one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(2, np.int64)
        for batch in batches:
            for rows in slices(batch, "text"):
                n += np.bincount(with_spans(rows.column("text")), minlength=2)
        yield pa.RecordBatch.from_arrays([pa.array(n[:1]), pa.array(n[1:])], names=["plain", "labelled"])

    found = docs.select("text").mapInArrow(tidy(run), "plain bigint, labelled bigint").agg(F.sum("plain"), F.sum("labelled")).first()
    return found[0] or 0, found[1] or 0


def train(docs: DataFrame, s: Settings) -> Field | None:
    """A field from a sample of (doc_id, text); None if no document has a base span.

    The sample takes documents by the hash of their id and text, those with
    and without a base span each at a rate of their own, and windows without
    a secret by the same hash and their place; so neither depends on
    partitions.  The driver gets the features of ``windows`` windows, in expectation;
    where the sampled documents have more, these are drawn from them by hash.
    """
    scale = 1 << 40
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.length("text"), F.substring("text", 1, 64)), F.lit(scale))
    counted = sizes(docs)
    if not counted[1]:
        return None
    limits = np.array([min(1.0, s.sample / max(n, 1)) * scale for n in counted])
    sample = docs.select(place.alias("place"), "text").where(F.col("place") < float(limits.max()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                places = rows.column("place").to_numpy()
                rows = rows.filter(pa.array(places < limits[with_spans(rows.column("text")).astype(np.int64)]))
                places = rows.column("place").to_numpy().astype(np.uint64)
                data, offsets = utf8(rows.column("text"))
                w = describe(data, offsets)
                if not len(w.start):
                    continue
                tags = np.zeros(len(w.start), np.int64)
                edges = np.searchsorted(w.doc, np.arange(rows.num_rows + 1))
                for k in with_base(data, offsets).tolist():
                    at = np.arange(edges[k], edges[k + 1])
                    tags[at] = _gold(rows.column("text")[k].as_py(), data[offsets[k] : offsets[k + 1]], w, at, int(offsets[k]))
                # By the document and the word's place in it: is a window that begins here used without a secret
                drawn = mix(mix(places)[w.doc] ^ (np.arange(len(tags)) - edges[w.doc]).astype(np.uint64))
                thin = drawn % np.uint64(s.thin) == 0
                starts = np.flatnonzero(w.first)
                out = []
                for a, b in zip(starts, np.append(starts[1:], len(tags)), strict=True):
                    for c in range(a, b, s.window):
                        t = tags[c : min(c + s.window, b)]
                        if t.any() or thin[c]:
                            t = np.where((t == I) & (np.arange(len(t)) == 0), B, t)
                            out.append({"place": int(mix(drawn[c : c + 1])[0] >> np.uint64(24)), "n": len(t), "f": w.features[c : c + len(t)].astype("<i4").tobytes(), "t": t.astype("i1").tobytes()})
                if out:
                    yield pa.RecordBatch.from_pylist(out, pa.schema([("place", pa.int64()), ("n", pa.int32()), ("f", pa.binary()), ("t", pa.binary())]))

    windows, path = stored(sample.mapInArrow(tidy(run), "place bigint, n int, f binary, t binary"), "crf-windows")
    share = min(1.0, s.windows / max(windows.count(), 1))
    got = windows.where(F.col("place") < int(share * scale)).toArrow().sort_by([("f", "ascending")])
    removed(docs.sparkSession, path)
    tags = np.frombuffer(b"".join(got.column("t").to_pylist()), np.int8).astype(np.int64)
    if not (tags == B).any():
        return None
    features = np.frombuffer(b"".join(got.column("f").to_pylist()), "<i4").reshape(-1, len(SIZES))
    return fit(features, tags, got.column("n").to_numpy().astype(np.int64), s)


RESULT = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
    "secrets array<struct<kind:string,start:bigint,end:bigint,text:string>>"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
     ("base_sha256", pa.string()), ("spans", pa.string()),
     ("secrets", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])))]
)
_NONE = hashlib.sha256(b"").hexdigest()


def scan(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, and the secrets' texts.

    Spans of the field that overlap a base span aren't repeated.  Null and
    empty texts have no spans.  Rows with equal ids are scanned each; a doc_id that
    is no number is null; other columns play no part.  A text is read whole,
    however long: the time grows with its length, and with the logarithm of its spans.
    """
    s = settings or Settings()
    rows = docs.select(F.col("doc_id").try_cast("bigint").alias("doc_id"), blank_text(F.col("text")).alias("text"))
    m = train(rows, s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part.column("text"))
                texts, added = part.column("text"), {}
                if m is not None:
                    w = describe(data, offsets)
                    added = tagged_spans(data, w, decode(w, m), s.least)
                out = [{"doc_id": i, "n_assign": 0, "n_access": 0, "n_hex": 0, "base_sha256": _NONE, "spans": "", "secrets": []}
                       for i in part.column("doc_id").to_pylist()]
                for k in sorted({*with_base(data, offsets).tolist(), *added}):
                    text = texts[k].as_py()
                    base = base_spans(text)
                    found, covered = list(base), Covered(base)
                    points = code_points(data[offsets[k] : offsets[k + 1]]) if k in added else None
                    for a, b in added.get(k, ()):
                        a, b = int(points[a - offsets[k]]), int(points[b - offsets[k]])
                        if not covered.touches(a, b):
                            found.append(Span(a, 3, b, a))
                    out[k] |= {
                        "n_assign": sum(x.kind == 0 for x in base), "n_access": sum(x.kind == 1 for x in base),
                        "n_hex": sum(x.kind == 2 for x in base),
                        "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(found),
                        "secrets": [{"kind": KINDS[x.kind], "start": x.start, "end": x.end, "text": text[x.start : x.end]} for x in sorted(found)],
                    }
                yield pa.RecordBatch.from_pylist(out, _ARROW)

    return rows.mapInArrow(tidy(run), RESULT)
