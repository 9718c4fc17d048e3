"""Documents drawn by importance, so that they come to resemble a target.

A document's features are its runs of 1 to ``order`` consecutive words, repeats
counted, hashed into ``buckets`` by the CRC-32 of their UTF-8 bytes (the words
lower-cased in A-Z, joined by one space).  A bucket that the target uses more
than the corpus does has a positive gain, and a document weighs the sum of its
features' gains.  Gumbel noise from a seeded hash of the id is added, and of the
documents with ``least_words`` words or more the ``percent`` with the highest
scores are drawn: a sample without replacement by weight.

CRCs are computed by length: the distinct features of a slice of texts whose
bytes have equal length form a matrix, and one table look-up a column moves all
its CRCs on by one byte.  Distinct features are told apart by 64-bit hashes (see
``common``).  The few features of more than ``LONG`` bytes, for which a matrix
would have many columns and hardly a row, get theirs one at a time.

Corpus and target are counted over all rows: a task adds its texts up in one
array of ``buckets`` counts, and the driver sees one number a bucket.  Ranks
come from a sort by ranges, not from one task.  Texts longer than a slice are
worked through in parts, whose runs of words go on across the cuts.

Null and empty texts have no feature, weight 0 and no rank.  A null id, or one
that is no number, is null and hashes as an empty text; ties of score go to the
smaller id, nulls last, and rows equal in both take adjoining ranks in any
order.  Repeated rows count each time.  An empty corpus gives no rows; with an
empty target, all gains stem from the corpus alone.  Other columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import ALNUM, BLOCK_BYTES, blank_text, free_prefix, mix, slices, tidy, utf8, words, written

#: Features of more bytes than this aren't gathered in matrices.
LONG = 256
#: Fixed value: the CRC-32 polynomial, reflected.
POLYNOMIAL = 0xEDB88320


@dataclass(frozen=True)
class Settings:
    #: Features are runs of 1 to so many words.
    order: int = 1
    buckets: int = 10_000
    seed: int = 2024
    percent: int = 10
    least_words: int = 20


# --- CRCs by length ------------------------------------------------------------------------


def crc_steps() -> np.ndarray:
    """What the low byte of a CRC turns the rest into."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


STEPS = crc_steps()


def crc_columns(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a matrix of bytes, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = STEPS[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return ~crc


def crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each piece data[start : start + length], by matrices of pieces of equal length."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    lengths, first = np.unique(length[order], return_index=True)
    for n, at in zip(lengths.tolist(), np.split(order, first[1:]), strict=True) if len(order) else ():
        if n > LONG:
            out[at] = [zlib.crc32(data[s : s + n]) for s in start[at].tolist()]
            continue
        step = max(1, BLOCK_BYTES // max(n, 1))
        for k in range(0, len(at), step):
            some = at[k : k + step]
            out[some] = crc_columns(data[start[some, None] + np.arange(n)])
    return out


# --- features of texts ---------------------------------------------------------------------


def _runs(data, offsets, order, carried=0):
    """(key, buffer, start, length, document) of all runs of 1 to ``order`` words that end
    after the first ``carried`` words; and the number of words of each document."""
    h, s, e, first = words(data, offsets, ALNUM)
    lens, doc = e - s, np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    if order == 1:
        return h[carried:], ALNUM[data], s[carried:], lens[carried:], doc[carried:], np.diff(first)
    # The words with one space after each: a run's bytes are then one piece.
    at = np.cumsum(lens + 1) - (lens + 1)
    joined = np.full(int((lens + 1).sum()), 32, np.uint8)
    inner = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    joined[np.repeat(at, lens) + inner] = ALNUM[data[np.repeat(s, lens) + inner]]
    keys, starts, lengths, docs = [], [], [], []
    key = h
    for n in range(1, order + 1):
        if n > 1:
            with np.errstate(over="ignore"):
                key = mix(key[:-1] * np.uint64(0x9FB21C651E98DF25) + h[n - 1 :] + np.uint64(n))
        last = np.arange(n - 1, len(h))
        ok = (doc[last - (n - 1)] == doc[last]) & (last >= carried)
        begin, last = last[ok] - (n - 1), last[ok]
        keys.append(key[ok])
        starts.append(at[begin])
        lengths.append(at[last] + lens[last] - at[begin])
        docs.append(doc[last])
        if len(h) <= n:
            break
    key, start, length, docs = map(np.concatenate, (keys, starts, lengths, docs))
    return key, joined, start, length, docs, np.diff(first)


def _cut(data: np.ndarray, at: int, most: int) -> int:
    """The end of a part that begins at ``at``: about ``most`` bytes on, between words."""
    end = min(at + most, len(data))
    while end < len(data) and ALNUM[data[end - 1]] and ALNUM[data[end]]:
        tail = ALNUM[data[end : end + most]] != 0
        end += len(tail) if tail.all() else max(1, int(np.argmin(tail)))
    return end


def features(column: pa.Array, s: Settings, most: int = 4 * BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For parts of the texts: (bucket of each feature, its document, words of each document)."""
    data, offsets = utf8(column)
    parts = [(data, offsets, 0)]
    if len(offsets) == 2 and len(data) > most:
        parts = _parts(data, s.order, most)
    for piece, bounds, carried in parts:
        key, buffer, start, length, doc, n_words = _runs(piece, bounds, s.order, carried)
        _, where, back = np.unique(key, return_index=True, return_inverse=True)
        bucket = (crcs(buffer, start[where], length[where]) % np.uint32(s.buckets)).astype(np.int64)
        n_words[0:1] -= carried
        yield bucket[back], doc, n_words


def _parts(data: np.ndarray, order: int, most: int):
    """One long text in parts; each begins with the last ``order - 1`` words before it."""
    at, starts = 0, np.zeros(0, np.int64)
    while at < len(data):
        end = _cut(data, at, most)
        begin, carried = (int(starts[0]), len(starts)) if len(starts) else (at, 0)
        piece = data[begin:end]
        yield piece, np.array([0, len(piece)]), carried
        if order > 1:
            fresh = words(data[at:end], np.array([0, end - at]), ALNUM)[1] + at
            starts = np.concatenate([starts, fresh])[-(order - 1) :]
        at = end


# --- counts, gains, weights ----------------------------------------------------------------


def bucket_counts(texts: DataFrame, s: Settings) -> np.ndarray:
    """Features in each bucket over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for batch in batches:
            for rows in slices(batch, "text"):
                for bucket, _, _ in features(rows.column("text"), s):
                    total += np.bincount(bucket, minlength=s.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    counts = texts.select(blank_text(F.col("text")).alias("text")).mapInArrow(tidy(count), "bucket int, n bigint")
    total = np.zeros(s.buckets, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        total[r["bucket"]] = r["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the corpus)), each count raised by one."""
    n, all_s, all_t = float(len(corpus)), float(corpus.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (all_s + n) / ((c + 1) * (all_t + n)))) for c, t in zip(corpus.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weighed(docs: DataFrame, gain: np.ndarray, s: Settings, carry: list[Column], prefix: str) -> DataFrame:
    """The columns of ``carry``, and with ``prefix``: words, features and weight of each text."""
    new = [f"{prefix}{c}" for c in ("n_words", "n_features", "weight")]
    text = f"{prefix}text"
    rows = docs.select(*carry, blank_text(F.col("text")).alias(text))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                n_words, n_features, weight = (np.zeros(part.num_rows, np.int64) for _ in range(3))
                for bucket, doc, n in features(part.column(text), s):
                    n_words += n
                    n_features += np.bincount(doc, minlength=len(n))
                    # Whole numbers in doubles: exact below 2^53.
                    weight += np.bincount(doc, gain[bucket].astype(np.float64), len(n)).astype(np.int64)
                kept = [part.column(k) for k in range(part.num_columns) if part.schema.names[k] != text]
                names = [n for n in part.schema.names if n != text]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, (n_words, n_features, weight))], names=[*names, *new])

    schema = rows.drop(text).schema
    for c in new:
        schema = schema.add(c, "long")
    return rows.mapInArrow(tidy(weigh), schema)


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256(``seed:id``)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


# --- the draw ------------------------------------------------------------------------------


def ranked(scores: DataFrame, s: Settings) -> DataFrame:
    """``scores`` (doc_id, n_words, score, row, ...) with ``rank``: null where not drawn.

    Rows that may be drawn are sorted by ranges and stored with their place;
    one count a range tells where each range's ranks begin.
    """
    spark = scores.sparkSession
    may = F.coalesce(F.col("n_words") >= s.least_words, F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    rows = scores.where(may).repartitionByRange(*order).sortWithinPartitions(*order)
    # Fixed by Spark: the partition's number from bit 33 on, below it the row's place there.
    stored = written(rows.withColumn("place", F.monotonically_increasing_id()), "importance-order")
    part, inner = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r["part"], r["n"]) for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    most = before[-1] * s.percent // 100
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part bigint, before bigint")
    rank = F.col("before") + inner + 1
    # A row for each range of the sort: as many as there are shuffle partitions.
    found = stored.withColumn("part", part).join(F.broadcast(starts), "part")
    found = found.withColumn("rank", F.when(rank <= most, rank)).select(*scores.columns, "rank")
    return found.unionByName(scores.where(~may).withColumn("rank", F.lit(None).cast("bigint")))


def corpus_gains(docs: DataFrame, target: DataFrame, s: Settings) -> np.ndarray:
    return gains(bucket_counts(docs, s), bucket_counts(target, s))


def resampled(docs: DataFrame, target: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank (null if not drawn)."""
    s = settings or Settings()
    rows = weighed(docs, corpus_gains(docs, target, s), s, [F.col("doc_id").try_cast("bigint").alias("doc_id")], "")
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), s.seed))
    stored = written(rows.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    return ranked(stored, s).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The drawn documents themselves, with all their columns.

    Documents are stored with their scores once; the last rank's score, id and
    row then part the drawn from the others without a join.
    """
    s = settings or Settings()
    p = free_prefix(docs, "importance_")
    rows = weighed(docs, corpus_gains(docs, target, s), s, [F.col(f"`{c}`") for c in docs.columns], p)
    rows = rows.withColumn(f"{p}id", F.col("doc_id").try_cast("bigint"))
    rows = rows.withColumn(f"{p}score", F.col(f"{p}weight") + noise(F.col(f"{p}id"), s.seed))
    stored = written(rows.withColumn(f"{p}row", F.monotonically_increasing_id()), "importance-drawn")
    thin = stored.select(*[F.col(f"{p}{c}").alias(a) for c, a in (("id", "doc_id"), ("n_words", "n_words"), ("score", "score"), ("row", "row"))])
    last = ranked(thin, s).where(F.col("rank").isNotNull()).agg(F.max(F.struct("rank", "score", "doc_id", "row")).alias("last")).first()["last"]
    if last is None:
        return stored.where(F.lit(False)).select(*[F.col(f"`{c}`") for c in docs.columns])
    score, row = F.col(f"{p}score"), F.col(f"{p}row")
    # Nulls come last among equal scores: as the pair (is null, id).
    mine = F.struct(F.col(f"{p}id").isNull(), F.coalesce(F.col(f"{p}id"), F.lit(0)), row)
    end = F.struct(F.lit(last["doc_id"] is None), F.lit(last["doc_id"] or 0).cast("bigint"), F.lit(last["row"]).cast("bigint"))
    within = (score > last["score"]) | ((score == last["score"]) & (mine <= end))
    return stored.where((F.col(f"{p}n_words") >= s.least_words) & within).select(*[F.col(f"`{c}`") for c in docs.columns])


# --- the same in SQL -----------------------------------------------------------------------


def resampled_sql(s: Settings | None = None) -> str:
    """DuckDB SQL for ``resampled(documents, benchmark)``."""
    s = s or Settings()
    split = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    grams = " || ".join(f"list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))" for n in range(1, s.order + 1))
    ln = f"ln((coalesce(t, 0) + 1)::DOUBLE * (S + {s.buckets}) / ((s + 1)::DOUBLE * (T + {s.buckets})))"
    hashed = f"('0x' || substr(sha256('{s.seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT"
    return f"""WITH steps AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {POLYNOMIAL}) ELSE c >> 1 END) ORDER BY i) AS step
  FROM range(256) r(i)),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents),
b AS MATERIALIZED (SELECT {split} AS w FROM benchmark),
df AS MATERIALIZED (SELECT r, f, count(*) AS n FROM (SELECT r, unnest({grams}) AS f FROM d) GROUP BY 1, 2),
bf AS MATERIALIZED (SELECT f, count(*) AS n FROM (SELECT unnest({grams}) AS f FROM b) GROUP BY 1),
known AS (SELECT f FROM df UNION SELECT f FROM bf),
bytes AS (SELECT f, list_transform(range(1, strlen(f) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT) AS b FROM known),
crc AS MATERIALIZED (
  SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1]))) % {s.buckets} AS bucket
  FROM bytes, steps),
sc AS (SELECT bucket, sum(n) AS s FROM df JOIN crc USING (f) GROUP BY 1),
tc AS (SELECT bucket, sum(n) AS t FROM bf JOIN crc USING (f) GROUP BY 1),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM sc) AS S_all, (SELECT coalesce(sum(t), 0) FROM tc) AS T_all),
gain AS MATERIALIZED (SELECT bucket, CAST(floor(1000 * {ln.replace("(S +", "(S_all +").replace("(T +", "(T_all +")}) AS BIGINT) AS g FROM sc LEFT JOIN tc USING (bucket), totals),
weights AS (SELECT r, sum(n) AS n_features, sum(n * g) AS weight FROM df JOIN crc USING (f) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(({hashed} + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r)),
placed AS (
  SELECT doc_id, n_features, weight, score, n_words >= {s.least_words} AS may,
    row_number() OVER (PARTITION BY n_words >= {s.least_words} ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN may AND place <= (SELECT {s.percent} * count(*) // 100 FROM placed WHERE may) THEN place END AS rank
FROM placed"""
