"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams (1 to 3 letters,
lower-cased, anything but letters read as one space).  Document frequencies
come from all training documents; the weights are fitted with
follow-the-regularised-leader (FTRL-proximal) under elastic-net penalties, on a
sample whose size is bounded by ``Settings.per_language`` and
``Settings.sample`` rows in expectation; the probabilities are then calibrated
with one temperature, fitted on a fifth of the sample that the weights never saw.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import blank_text, fold_of, free_prefix, slices, tidy, written

UNKNOWN = "und"
#: Code points that one vectorised step looks at.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Settings:
    bits: int = 15
    longest: int = 3
    #: Expected sample rows of each language, and of all languages together.
    per_language: int = 1000
    sample: int = 20_000
    epochs: int = 2
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.01


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features and, last, the bias; a column a label
    temperature: float
    settings: Settings


# --- features ----------------------------------------------------------------------------------

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def _codes(text: str, s: Settings) -> Iterator[tuple[np.ndarray, int]]:
    """(code points of the text's letters with single spaces between and around, how many of
    them were in the block before), block by block."""
    last = np.array([32], np.uint32)
    for at in range(0, len(text), BLOCK):
        c = np.frombuffer(text[at : at + BLOCK].lower().encode("utf-32-le", "replace"), np.uint32)
        c = np.where(_letters()[c], c, np.uint32(32))
        c = np.concatenate([last, c])
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
        c = c[keep]
        yield c, len(last)
        last = c[-max(1, s.longest - 1) :]
    if last[-1] != 32:
        yield np.concatenate([last, np.array([32], np.uint32)]), len(last)


def _buckets(c: np.ndarray, new: int, s: Settings) -> Iterator[np.ndarray]:
    """Buckets of the n-grams that end at one of the last ``new`` places."""
    salt = (0, 0x3C6EF372, 0xDAA66D2B, 0x78DDE6E4, 0x1715609D)
    times = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, s.longest + 1):
            first = max(0, len(c) - new - n + 1)
            m = len(c) - n + 1 - first
            if m <= 0:
                continue
            h = np.full(m, salt[n], np.uint32)
            for k in range(n):
                h += c[first + k : first + k + m] * times[k]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            h ^= h >> np.uint32(13)
            h *= np.uint32(0x297A2D39)
            yield h >> np.uint32(32 - s.bits)


def counts(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, how often) of a whole text; none if it has no letter."""
    total, letters = np.zeros(1 << s.bits, np.int64), False
    for c, held in _codes(text, s):
        letters = letters or bool((c != 32).any())
        for b in _buckets(c, len(c) - held, s):
            total += np.bincount(b, minlength=len(total))
    at = np.flatnonzero(total) if letters else np.zeros(0, np.int64)
    return at, total[at]


def weighted(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(n)) * idf[at]
    return x / (np.sqrt((x * x).sum()) or 1.0)


# --- training ----------------------------------------------------------------------------------

PARTS = "bucket int, docs bigint, label string, place bigint, at array<int>, n array<int>"
_PARTS = pa.schema(
    [("bucket", pa.int32()), ("docs", pa.int64()), ("label", pa.string()), ("place", pa.int64()),
     ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]
)


def _statistics(rows: DataFrame, s: Settings) -> DataFrame:
    """Of (text, label, place, sampled): document frequencies of each task, and the sample's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs = np.zeros(1 << s.bits, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                labels, places, sampled = (part.column(c).to_pylist() for c in ("label", "place", "sampled"))
                for k, text in enumerate(part.column("text").to_pylist()):
                    at, n = counts(text, s)
                    df[at] += 1
                    docs += 1
                    if sampled[k] and len(at):
                        out.append({"label": labels[k], "place": places[k], "at": at.tolist(), "n": n.tolist()})
                if out:
                    yield pa.RecordBatch.from_pylist(out, _PARTS)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pylist(
            [{"bucket": -1, "docs": docs}, *({"bucket": b, "docs": d} for b, d in zip(at.tolist(), df[at].tolist(), strict=True))], _PARTS
        )

    return rows.mapInArrow(tidy(run), PARTS)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_labels: int, s: Settings) -> np.ndarray:
    """Weights after ``epochs`` passes over (features, values, label), one example at a time."""
    d = (1 << s.bits) + 1
    z, n = np.zeros((d, n_labels)), np.zeros((d, n_labels))
    l1 = np.full((d, 1), s.l1)
    l1[-1] = 0

    def read(at: np.ndarray) -> np.ndarray:
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)

    rng = np.random.default_rng(11)
    for _ in range(s.epochs):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, d - 1), np.append(x, 1.0)
            w = read(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / s.alpha * w
            n[at] = new
    return read(np.arange(d))


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature, between 0.05 and 20, that makes the labels most likely.

    One wrong label per class is added to n right ones (labels smoothed by
    k / (n + k)), so that a sample without errors doesn't ask for certainty.
    """
    if not len(y):
        return 1.0
    smooth = logits.shape[1] / (len(y) + logits.shape[1])

    def loss(log_t: float) -> float:
        x = logits / np.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        right = (1 - smooth) * x[np.arange(len(y)), y] + smooth * x.mean(axis=1)
        return float((np.log(np.exp(x).sum(axis=1)) - right).mean())

    low, high, ratio = np.log(0.05), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(50):  # golden section; the loss is convex in 1 / t and so has one minimum
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, learn: Column, settings: Settings | None = None) -> Model:
    """Fits a model on the rows of ``docs`` (doc_id, text, lang) where ``learn`` is true and lang isn't null.

    The sample takes a document if the hash of its id is low enough for its
    language's share.  The driver gets one row per bucket and the sample.
    Without any training row the model has no labels.
    """
    s = settings or Settings()
    rows = docs.where(learn & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(sizes)
    if not labels:
        return Model([], np.ones(1 << s.bits), np.zeros(((1 << s.bits) + 1, 0)), 1.0, s)
    each = min(s.per_language, s.sample // len(labels))
    place = F.xxhash64(F.col("doc_id").cast("string"))
    share = F.create_map(*[F.lit(x) for k in labels for x in (k, min(1.0, each / sizes[k]))])
    scale = 1 << 20
    parts = written(
        _statistics(
            rows.select(
                blank_text(F.col("text")).alias("text"), F.col("lang").alias("label"), place.alias("place"),
                (F.pmod(place, F.lit(scale)) < share[F.col("lang")] * scale).alias("sampled"),
            ),
            s,
        ),
        "langid-parts",
    )
    df = np.zeros(1 << s.bits, np.int64)
    total = 0
    for r in parts.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("docs").alias("docs")).collect():
        if r["bucket"] < 0:
            total = r["docs"]
        else:
            df[r["bucket"]] = r["docs"]
    idf = np.log((1 + total) / (1 + df)) + 1
    number = {k: i for i, k in enumerate(labels)}
    sample = parts.where("bucket IS NULL").select("label", "place", "at", "n").toArrow()
    rows_ = []
    for batch in sample.to_batches():
        at, n = batch.column("at"), batch.column("n")
        for k, (label, where) in enumerate(zip(batch.column("label").to_pylist(), batch.column("place").to_pylist(), strict=True)):
            a = at[k].values.to_numpy()
            rows_.append((where, number[label], a, weighted(a, n[k].values.to_numpy(), idf).astype(np.float32)))
    rows_.sort(key=lambda r: (r[0], r[1], len(r[2])))
    fit = [(a, x, y) for where, y, a, x in rows_ if where % 5]
    rest = [(a, x, y) for where, y, a, x in rows_ if not where % 5]
    weights = ftrl(fit, len(labels), s)
    logits = np.array([x @ weights[a] + weights[-1] for a, x, _ in rest]).reshape(-1, len(labels))
    return Model(labels, idf, weights, calibrate(logits, np.array([y for _, _, y in rest], np.int64)), s)


# --- prediction ----------------------------------------------------------------------------------


def predict_one(text: str | None, m: Model) -> tuple[str, float]:
    at, n = counts(text or "", m.settings)
    if not len(at) or not m.labels:
        return UNKNOWN, 0.0
    p = _softmax((weighted(at, n, m.idf) @ m.weights[at] + m.weights[-1]) / m.temperature)
    return m.labels[int(p.argmax())], float(min(p.max(), 1.0))


def predict(docs: DataFrame, m: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted label and its calibrated probability, from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0, as is any
    text if the model has no labels; ties go to the label that sorts first.
    """
    given = docs.withColumns({names[0]: F.lit(""), names[1]: F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                found = [predict_one(t, m) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=[*part.schema.names, *names],
                )

    return docs.mapInArrow(tidy(run), given)


def language_table(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Learns from documents whose crc32(doc_id as text) mod 4 isn't 2; a null id
    is neither held out nor learned from.  An empty table gives no rows; other
    columns play no part.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    fold = fold_of(F.col("doc_id"), 4)
    model = train(rows, F.coalesce(fold != 2, F.lit(False)), settings)
    held = F.coalesce(fold == 2, F.lit(False)).alias("held_out")
    return predict(rows.select("doc_id", held, "text"), model).drop("text")


def least_probability(n_labels: int, margin: float) -> float:
    """The share ``margin`` of the way from chance, one of ``n_labels``, to certainty."""
    return min(1.0, 1 / n_labels + margin * (1 - 1 / n_labels))


def keep_known(docs: DataFrame, least: float | Callable[[int], float], settings: Settings | None = None) -> DataFrame:
    """The documents whose language is found with a probability of ``least`` or more.

    ``least`` may depend on the number of learned labels: with ``least_probability``
    it asks as much of a text with two labels as with fifty, as a text that says
    nothing gets the probability of chance.  Learns
    from the documents' own lang column, as ``language_table`` does; those without a
    letter (null and empty texts are) are rejected.  With a single label every text
    with a letter is in it, and where no document has a lang there is no model to
    reject by: all documents with a letter stay.  Rows are judged each by itself,
    repeated ones alike; columns come back as they are.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(rows, F.coalesce(fold_of(F.col("doc_id"), 4) != 2, F.lit(False)), settings)
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    prefix = free_prefix(docs, "langid_")
    names = (f"{prefix}label", f"{prefix}score")
    found = predict(docs, model, names=names)
    if callable(least):
        least = least(len(model.labels))
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*docs.columns)
