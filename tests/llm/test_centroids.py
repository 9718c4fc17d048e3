import random
from hashlib import sha256

import numpy as np
import pytest

from scorewell.llm import centroids
from scorewell.llm.centroids import Settings, cluster_sql, cluster_table, cluster_sums, moved, nearest, product
from scorewell.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, s):
    """Plain Python, whole numbers throughout, all distances anew each round."""
    vs = [
        (i, [int(np.floor(s.scale * x)) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == s.dim and all(x is not None and np.isfinite(x) for x in v)
    ]
    def hashed(r):
        return sha256(f"{s.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is None, r[0] or 0, r[1]

    cs = [v for _, v in sorted(vs, key=hashed)[: s.clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cs)) for _, v in vs]

    for _ in range(s.rounds):
        near = assign()
        for k in range(len(cs)):
            if mine := [v for (_, v), (_, m) in zip(vs, near) if m == k]:
                cs[k] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assign()
    by = [sum(d for d, m in near if m == k) for k in range(len(cs))]
    return sorted(
        ((i, m, d, by[m], sum(by), sha256(",".join(map(str, cs[m])).encode()).hexdigest()) for (i, _), (d, m) in zip(vs, near)), key=key
    )


def key(row):
    return tuple((x is None, x or 0) for x in row)


def vectors(n, dim, seed=1, wide=1.0):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, wide) for _ in range(dim)] for _ in range(5)]
    return [(k * 7 % 1009, [x + rnd.gauss(0, 0.2) for x in middles[k % 5]], k) for k in range(n)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("s", [Settings(clusters=7, dim=6, block=16), Settings(clusters=3, dim=6, rounds=1, scale=10), Settings(clusters=5, dim=6, rounds=0)])
def test_equals_brute_force(spark, s):
    rows = vectors(150, 6) + [(2000, None, 0), (2001, [0.0] * 5, 0), (2002, [], 0), (2003, [0.0] * 5 + [None], 0), (2004, [float("nan")] * 6, 0)]
    rows += [(2005, [float("inf")] + [0.0] * 5, 0), (2006, [0.0] * 6, 0), (None, [1.0] * 6, 0), (None, [1.0] * 6, 0), (7, [0.5] * 6, 1), (7, [0.25] * 6, 1)]
    df = frame(spark, rows).selectExpr("*", "'x' AS cluster", "'y' AS vec", "'z' AS ids", "1 AS distance")
    got = cluster_table(df, s)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == brute(rows, s)


def test_equal_vectors_leave_centroids_empty(spark):
    """A third of all rows is one vector: it starts several centroids, of which the first gets it."""
    s = Settings(clusters=12, dim=4)
    rows = vectors(40, 4) + [(3000 + k, [0.5, -0.5, 0.25, 0.0], 0) for k in range(40)]
    assert sorted(map(tuple, cluster_table(frame(spark, rows, 5), s).collect()), key=key) == brute(rows, s)


def test_fewer_vectors_than_clusters_and_none(spark):
    s = Settings(clusters=40, dim=4)
    rows = vectors(6, 4)
    assert sorted(map(tuple, cluster_table(frame(spark, rows), s).collect()), key=key) == brute(rows, s)
    assert cluster_table(frame(spark, rows).where("false"), s).count() == 0
    assert cluster_table(frame(spark, [(1, None, 0)]), s).count() == 0


def test_large_components_stay_exact_and_too_large_ones_fail(spark):
    s = Settings(clusters=4, dim=3)
    top = s.largest / s.scale
    rows = [(k, [top * (k % 3 - 1), top / (k + 1), -top if k % 2 else 0.1], 0) for k in range(30)]
    assert sorted(map(tuple, cluster_table(frame(spark, rows), s).collect()), key=key) == brute(rows, s)
    with pytest.raises(Exception, match="too large for exact distances: vec_id 5"):
        cluster_table(frame(spark, [(5, [top * 2, 0.0, 0.0], 0)]), s).collect()


def test_products_change_by_changed_components_alone(monkeypatch):
    rng = np.random.default_rng(3)
    v, old = rng.integers(-300, 300, (8, 50)), rng.integers(-300, 300, (6, 8))
    new = old.copy()
    new[1, 3] += 5
    new[4, [0, 7]] -= 9
    seen = []
    monkeypatch.setattr(centroids, "product", lambda a, b: (seen.append(a.shape), product(a, b))[1])
    assert (moved(v, old @ v, new - old) == new @ v).all()
    assert seen == [(1,), (2,)]  # two centroids, one and two components
    label, distance = nearest(v, new @ v, new)
    full = ((v.T[:, None, :] - new[None]) ** 2).sum(axis=2)
    assert (distance == full.min(axis=1)).all() and (label == full.argmin(axis=1)).all()
    sums = cluster_sums(v, label, 6)
    assert all((sums[k, 1:] == v[:, label == k].sum(axis=1)).all() and sums[k, 0] == (label == k).sum() for k in range(6))


def test_sums_beyond_doubles():
    a = np.array([[2**28 + 1, 1]])
    assert product(a, a.T).tolist() == [[(2**28 + 1) ** 2 + 1]]


def test_old_blocks_are_removed(spark, tmp_path, monkeypatch):
    seen = []
    store = centroids.stored
    monkeypatch.setattr(centroids, "stored", lambda df, label: (seen.append((x := store(df, label))[1]), x)[1])
    df, _ = centroids.assigned(frame(spark, vectors(80, 4)), Settings(clusters=6, dim=4))
    assert len(seen) > 2 and df.count() == 80
    import os

    there = [os.path.exists(p.removeprefix("file:")) for p in seen]
    assert there == [False] * (len(seen) - 1) + [True]


def test_sql_gives_the_same_rows(spark):
    import duckdb

    s = Settings(clusters=10, rounds=3)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    got = cluster_table(table(spark, SF_SMALL, "embeddings"), s)
    want = db.sql(f"SELECT {', '.join(got.columns)} FROM ({cluster_sql(s)})").fetchall()
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
