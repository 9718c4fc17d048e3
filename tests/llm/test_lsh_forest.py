import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewell.llm.lsh_forest import BITS, Settings, Shard, nearest_table, search, squares
from tests.conftest import SF_ORACLE

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(ids, x, queries, k=10):
    out = {}
    for q in queries:
        own = x[ids == q][0]
        at = np.flatnonzero(ids != q)
        d = np.sqrt(((x[at] - own) ** 2).sum(axis=1))
        best = np.lexsort((ids[at], d))[:k]
        out[q] = [(int(ids[at[b]]), float(d[b])) for b in best]
    return out


def test_recall_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    want = exact(ids, x, [int(i) for i in ids if i % 10 == 0])
    got = {}
    for r in search(table, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    hits = sum(len({r.vec_id for r in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len(w) for w in want.values())
    of = {int(i): v for i, v in zip(ids, x)}
    for q, rs in got.items():
        assert [r["rank"] for r in rs] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in rs] == sorted((r.score, r.vec_id) for r in rs)
        for r in rs:
            assert r.score == pytest.approx(float(np.sqrt(((of[q] - of[r.vec_id]) ** 2).sum())), rel=1e-14)


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS label", "1 AS vec", "2 AS query").repartition(3)


def test_full_reach_is_exact_and_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-2, 3, (300, 4)).astype(np.float32)  # many ties and repeats
    x[(x == 0).all(axis=1)] = 1
    rows = [(int(k), [float(v) for v in r]) for k, r in enumerate(x)]
    got = {}
    for r in search(make(spark, rows), F.col("vec_id") % 100 == 0, Settings(reach=1.0, shard=64)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == exact(np.arange(300), x.astype(np.float64), [0, 100, 200])


def test_unusable_rows_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (8, []), (9, [-1.0, 0.0]), (9, [-1.0, 0.0]), (100, [0.0, 0.0]), (200, [0.5, 0.5])]
    got = {}
    for r in nearest_table(make(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 200, 9, 9], 200: [1, 0, 9, 9]} or got == {0: [1, 200, 9, 9], 200: [0, 1, 9, 9]}


def test_few_rows_give_all_candidates(spark):
    rows = [(k * 100, [1.0 + k, 1.0]) for k in range(4)]
    got = nearest_table(make(spark, rows)).collect()
    assert len(got) == 4 * 3


def test_blocks_of_queries_and_shards_give_the_same(spark):
    rng = np.random.default_rng(3)
    rows = make(spark, [(k, [float(v) for v in r]) for k, r in enumerate(rng.normal(size=(400, 8)))])
    one = lambda s: sorted(map(tuple, search(rows, F.col("vec_id") % 20 == 0, s).collect()))
    assert one(Settings(reach=1.0)) == one(Settings(reach=1.0, block=3, shard=50))


def test_empty_and_no_queries(spark):
    rows = make(spark, [(1, [1.0])])
    assert nearest_table(rows).count() == 0 and nearest_table(rows.where("false")).count() == 0
    assert nearest_table(make(spark, [(100, [0.0])])).count() == 0


def test_prefixes_are_the_longest_of_all_trees():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2**64 - 1, (3, 200), dtype=np.uint64) >> np.uint64(0)
    codes[:, :50] = codes[:, 50:100] ^ (np.uint64(1) << rng.integers(0, 63, (3, 50)).astype(np.uint64))
    places = np.argsort(codes, axis=1, kind="stable")
    shard = Shard(np.arange(200), np.zeros((200, 1)), np.take_along_axis(codes, places, axis=1), places.astype(np.int32))
    for q in range(0, 200, 7):
        same = [[BITS - (int(c) ^ int(codes[t, q])).bit_length() for c in codes[t]] for t in range(3)]
        want = np.max(same, axis=0)
        assert shard.prefixes(codes[:, q]).tolist() == want.tolist()
        at_least = shard.prefixes(codes[:, q], 5)
        assert np.where(want >= 5, want, 0).tolist() == at_least.tolist()


def test_clustered_vectors_need_a_reach_of_a_few_percent(spark):
    """Where vectors lie in clusters, prefixes find the neighbours among two in a hundred rows."""
    rng = np.random.default_rng(1)
    n, middles = 4000, rng.standard_normal((100, 32))
    x = middles[rng.integers(0, 100, n)] + 0.15 * rng.standard_normal((n, 32))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(4)
    found = {}
    for r in search(df, F.col("vec_id") % 100 == 0, Settings(reach=0.02)).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in range(0, n, 100):
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(found[q] & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 10 * (n // 100)


def test_rough_distances_bound_the_exact_ones():
    """Also for nearly equal and for very large vectors: what the slack lets through holds the exact nearest."""
    rng = np.random.default_rng(7)
    for scale in (1e-3, 1.0, 1e6, 1e200):
        x = scale * (1 + 1e-9 * rng.standard_normal((300, 16)))
        q = x[:5] + scale * 1e-9 * rng.standard_normal((5, 16))
        rough, slack = squares(x, q)
        with np.errstate(over="ignore"):
            exact = ((x[:, None] - q[None]) ** 2).sum(axis=2)
        for k in range(5):
            allowed = rough[:, k] <= np.partition(rough[:, k], 9)[9] + slack[k]
            assert allowed[np.argsort(exact[:, k], kind="stable")[:10]].all()
