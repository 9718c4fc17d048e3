import math
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from scorewell.llm import importance
from scorewell.llm.common import table
from scorewell.llm.importance import Settings, crcs, drawn, features, resampled, resampled_sql
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, order):
    w = WORD.findall((text or "").translate(UPPER))
    return w, [" ".join(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def bucket(feature, s):
    return zlib.crc32(feature.encode()) % s.buckets


def brute(rows, target, s):
    """{position: (doc_id, n_features, weight, score)} and the positions in order of rank."""
    found = [(i, *grams(text, s.order)) for i, text, *_ in rows]
    corpus, aim = np.zeros(s.buckets, int), np.zeros(s.buckets, int)
    for _, _, fs in found:
        for f in fs:
            corpus[bucket(f, s)] += 1
    for text in target:
        for f in grams(text, s.order)[1]:
            aim[bucket(f, s)] += 1
    n = s.buckets
    gain = [math.floor(1000 * math.log((t + 1) * (corpus.sum() + n) / ((c + 1) * (aim.sum() + n)))) for c, t in zip(corpus, aim)]
    out = []
    for i, _, fs in found:
        weight = sum(gain[bucket(f, s)] for f in fs)
        h = int(sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = [k for k, (_, w, _) in enumerate(found) if len(w) >= s.least_words]
    may.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    return out, may[: len(may) * s.percent // 100]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def corpus(n=300):
    rnd = random.Random(5)
    vocab = [f"w{k}" for k in range(60)] + ["École", "naïve", "日本", "X1", "a" * 300, "Long" * 100]
    rows = [(k * 13 % 997, " ".join(rnd.choice(vocab[k % 20 :]) for _ in range(rnd.randrange(45)))) for k in range(n)]
    return rows + [(2000, None), (2001, ""), (2002, "-- !!"), (None, "null id " * 15), (None, "null id " * 15), (2003, rows[1][1]), (2003, rows[1][1])]


TARGET = ["w1 w2 w3, École. w1 X1", "w59 w58 naïve " * 4, None, "", "unseen words"]


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(k, t) for k, t in enumerate(TARGET)], "item_id bigint, text string")


def test_crcs_by_length():
    rnd = random.Random(1)
    pieces = [bytes(rnd.randrange(256) for _ in range(n)) for n in [0, 1, 1, 2, 5, 5, 5, 31, 256, 257, 1000, 5] * 7]
    data = np.frombuffer(b"".join(pieces), np.uint8)
    length = np.array([len(p) for p in pieces])
    assert crcs(data, np.cumsum(length) - length, length).tolist() == [zlib.crc32(p) for p in pieces]
    assert len(crcs(data, length[:0], length[:0])) == 0


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("most", [7, 64, 1 << 22])
def test_features_of_texts_and_of_their_parts(order, most):
    s = Settings(order=order, buckets=5000)
    for text in [r[1] for r in corpus(30)] + ["one", "a b", "é" * 40 + " x", " , "]:
        got, n = [], 0
        for b, doc, n_words in features(pa.array([text], pa.string()), s, most):
            assert len(n_words) == 1 and not doc.any()
            got += b.tolist()
            n += int(n_words[0])
        w, fs = grams(text, order)
        assert n == len(w) and sorted(got) == sorted(bucket(f, s) for f in fs)


@pytest.mark.parametrize("s", [Settings(least_words=10), Settings(order=3, buckets=97, percent=37, seed=1, least_words=5), Settings(percent=0), Settings(percent=100, least_words=0)])
def test_equals_brute_force(make, target, s):
    rows = corpus()
    want, order = brute(rows, TARGET, s)
    got = [tuple(r) for r in resampled(make(rows, clash=True, parts=7), target, s).collect()]
    assert sorted((r[:4] for r in got), key=key) == sorted(want, key=key)
    ranks = sorted((r for r in got if r[4] is not None), key=lambda r: r[4])
    assert [r[4] for r in ranks] == list(range(1, len(order) + 1))
    assert [r[:4] for r in ranks] == [want[k] for k in order]


def test_drawn_documents_are_those_with_a_rank(make, target):
    rows, s = corpus(), Settings(least_words=10, percent=30)
    _, order = brute(rows, TARGET, s)
    docs = make(rows, clash=True, parts=4)
    got = drawn(docs.withColumn("importance_row", docs.doc_id), target, s)
    assert got.columns == [*docs.columns, "importance_row"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(((rows[k][0], rows[k][1]) for k in order), key=key)


def test_ties_at_the_end_of_the_draw(make, target):
    """Repeated rows with equal scores: as many as the share asks for."""
    rows = [(7, "same words " * 20)] * 50
    s = Settings(percent=30)
    docs = make(rows, parts=6)
    assert sorted(r["rank"] for r in resampled(docs, target, s).collect() if r["rank"]) == list(range(1, 16))
    assert drawn(docs, target, s).count() == 15


def test_empty_tables(make, target):
    none = make([(1, "a")]).where("false")
    assert resampled(none, target).count() == 0 and drawn(none, target).count() == 0
    rows, s = corpus(40), Settings(least_words=3)
    want, _ = brute(rows, [], s)
    got = resampled(make(rows), target.where("false"), s).collect()
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)


def test_text_of_more_than_a_slice(make, target):
    rows, s = corpus(25) + [(5000, "w1 w2 École " * 400_000)], Settings(order=2, least_words=3, percent=50)
    want, _ = brute(rows, TARGET, s)
    assert sorted((tuple(r)[:4] for r in resampled(make(rows), target, s).collect()), key=key) == sorted(want, key=key)


def test_hot_document_moves_one_row_a_bucket_and_task(make):
    """A third of all features in one bucket reach the shuffle as one row a task."""
    rows = [(k, "hot " * 50 + f"w{k}") for k in range(200)]
    counts = importance.bucket_counts(make(rows, parts=5), Settings())
    assert counts.sum() == 200 * 51 and counts.max() >= 200 * 50


@pytest.mark.parametrize("order", [1, 2])
def test_sql_gives_the_same_rows(spark, order):
    import duckdb

    s = Settings(order=order)
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = resampled(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark"), s).collect()
    want = db.sql(f"SELECT doc_id, n_features, weight, score, rank FROM ({resampled_sql(s)})").fetchall()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r["rank"] is not None for r in got) > 5
