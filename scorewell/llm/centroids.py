"""Centroid clustering on whole numbers, with an incremental distance matrix.

Vectors are turned into whole numbers once.  What is kept from round to round is,
for every vector, its exact dot product with every centroid.  When centroids move,
a vector's product with one changes only by the components in which that centroid
changed, so a round adds ``V[:, J] @ (new - old)[J]`` for those components J and
leaves the rest; the squared distance is then ``v.v - 2 v.c + c.c`` and the
nearest centroid its argmin (ties: the smaller number).  The first products are
such a change as well, from centroids of zeros.  All numbers are exact: doubles do
the products where every sum stays below 2^53, 64-bit integers elsewhere.

Vectors lie in blocks of bounded size, a row per block with its vectors, products
and the sums of its clusters.  A round reads the stored blocks, writes new ones to
the shared folder and then removes the old; the sums come from a scan of their
column alone.  The driver holds the centroids, and gets ``clusters`` x ``dim`` sums
a round, whatever the number of vectors.

Vectors that are null, that hold a null or non-finite component, or that have not
exactly ``dim`` components take no part.  A component beyond what exact 64-bit
distances allow (2^27 in size after scaling, for 64 components) fails the job, as
leaving it out or rounding it would be a wrong result.  Repeated rows are vectors
each by itself; a null vec_id, or one that is no number, is null and hashes as an
empty text.  Equal hashes order by id, nulls last, then by vector.  With fewer
vectors than ``clusters`` there is a centroid a vector; centroids that start equal
tie, so all but the first of them stay empty where they are.  An empty table gives
no rows.  Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import removed, stored, tidy


@dataclass(frozen=True)
class Settings:
    clusters: int = 40
    rounds: int = 5
    dim: int = 64
    #: A component x counts as floor(scale * x).
    scale: int = 256
    seed: int = 2
    block: int = 8192

    @property
    def largest(self) -> int:
        """Components up to this size have distances that fit in 62 bits."""
        return isqrt((1 << 62) // self.dim) // 2


def kept(vectors: DataFrame, s: Settings) -> DataFrame:
    """(vec_id, vec) of the vectors that take part, as whole numbers in doubles."""
    raw = F.col("embedding").cast("array<double>")
    bad = F.exists(raw, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(raw, lambda x: F.floor(F.lit(float(s.scale)) * x).cast("double"))
    far = F.exists(whole, lambda x: F.abs(x) > float(s.largest))
    vec = F.when(far, F.raise_error(F.concat(F.lit("component too large for exact distances: vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))).cast("array<double>")).otherwise(whole)
    return vectors.where(F.coalesce((F.size(raw) == s.dim) & ~bad, F.lit(False))).select(
        F.col("vec_id").try_cast("bigint").alias("vec_id"), vec.alias("vec")
    )


def first_centroids(rows: DataFrame, s: Settings) -> np.ndarray:
    """The vectors whose seeded hashes are smallest, in ascending order: ``clusters`` rows at most."""
    h = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = rows.orderBy(h, F.col("vec_id").asc_nulls_last(), "vec").limit(s.clusters).select("vec").collect()
    return np.array([r["vec"] for r in found], np.float64).astype(np.int64).reshape(len(found), s.dim)


# --- blocks --------------------------------------------------------------------------------

BLOCK = "ids array<bigint>, vectors binary, dots binary, labels binary, distances binary, sums binary"
_BLOCK = pa.schema([("ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("vectors", "dots", "labels", "distances", "sums"))])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of whole numbers, exact."""
    if a.size and b.size and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[-1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def moved(vectors: np.ndarray, dots: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The products after centroids changed: only by components that did."""
    out = dots.copy()
    for k in np.flatnonzero(change.any(axis=1)):
        j = np.flatnonzero(change[k])
        out[k] += product(change[k, j], vectors[j])
    return out


def nearest(vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each vector."""
    d = (centroids * centroids).sum(axis=1)[:, None] - 2 * dots
    label = np.argmin(d, axis=0)
    return label, np.take_along_axis(d, label[None], axis=0)[0] + (vectors * vectors).sum(axis=0)


def cluster_sums(vectors: np.ndarray, label: np.ndarray, k: int) -> np.ndarray:
    """k x (1 + dim): the number of vectors in each cluster and the sum of their components."""
    member = (label == np.arange(k)[:, None]).astype(np.int64)
    return np.concatenate([member.sum(axis=1)[:, None], product(member, np.ascontiguousarray(vectors.T))], axis=1)


def _block(ids: pa.Array, vectors: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    label, distance = nearest(vectors, dots, centroids)
    sums = cluster_sums(vectors, label, len(centroids))
    bytes_ = [vectors.astype("<i4"), dots.astype("<i8"), label.astype("<i4"), distance.astype("<i8"), sums.astype("<i8")]
    columns = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
    return pa.RecordBatch.from_arrays(columns + [pa.array([b.tobytes()], pa.binary()) for b in bytes_], schema=_BLOCK)


def start(rows: DataFrame, centroids: np.ndarray, s: Settings) -> DataFrame:
    """The blocks of all vectors with their products, components by vectors, and their nearest centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, s.block):
                part = batch.slice(at, s.block)
                v = np.ascontiguousarray(part.column("vec").flatten().to_numpy().astype(np.int64).reshape(-1, s.dim).T)
                none = np.zeros((len(centroids), v.shape[1]), np.int64)
                yield _block(part.column("vec_id").cast(pa.int64()), v, moved(v, none, centroids), centroids)

    return rows.mapInArrow(tidy(run), BLOCK)


def step(blocks: DataFrame, change: np.ndarray, centroids: np.ndarray, s: Settings) -> DataFrame:
    """The blocks after the centroids moved by ``change`` to ``centroids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("ids").slice(k, 1).flatten()
                v = np.frombuffer(batch.column("vectors")[k].as_buffer(), "<i4").astype(np.int64).reshape(s.dim, -1)
                dots = np.frombuffer(batch.column("dots")[k].as_buffer(), "<i8").reshape(len(centroids), -1)
                yield _block(ids, v, moved(v, dots, change), centroids)

    return blocks.select("ids", "vectors", "dots").mapInArrow(tidy(run), BLOCK)


def totals(blocks: DataFrame, k: int, s: Settings) -> np.ndarray:
    """The blocks' sums added up: in each task first, then by Spark; as Python's whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * (1 + s.dim), np.int64)
        for batch in batches:
            for sums in batch.column("sums"):
                total += np.frombuffer(sums.as_buffer(), "<i8")
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["place", "n"])

    parts = blocks.select("sums").mapInArrow(run, "place int, n bigint")
    out = np.zeros(k * (1 + s.dim), object)
    for r in parts.groupBy("place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect():  # k * (1 + dim) rows at most
        out[r["place"]] = int(r["n"])
    return out.reshape(k, 1 + s.dim)


def means(total: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) by component; centroids without vectors stay."""
    out = centroids.copy()
    for k, (n, *sums) in enumerate(total.tolist()):
        if n:
            out[k] = [x // n for x in sums]
    return out


# --- the clustering ------------------------------------------------------------------------


def assigned(vectors: DataFrame, settings: Settings | None = None) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector that takes part, the final centroids)."""
    s = settings or Settings()
    spark, rows = vectors.sparkSession, kept(vectors, s)
    centroids = first_centroids(rows, s)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    blocks, path = stored(start(rows, centroids, s), "centroid-blocks")
    for _ in range(s.rounds):
        new = means(totals(blocks, len(centroids), s), centroids)
        change, centroids = new - centroids, new
        if not change.any():  # the further rounds would change nothing
            break
        old = path
        blocks, path = stored(step(blocks, change, centroids, s), "centroid-blocks")
        removed(spark, old)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                label, distance = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in (("labels", "<i4"), ("distances", "<i8")))
                columns = [batch.column("ids").slice(k, 1).flatten(), pa.array(label), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return blocks.select("ids", "labels", "distances").mapInArrow(run, "vec_id bigint, cluster int, distance bigint"), centroids


def digest(centroid: np.ndarray) -> str:
    return sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_table(vectors: DataFrame, settings: Settings | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector."""
    spark = vectors.sparkSession
    rows, centroids = assigned(vectors, settings)
    by = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()  # a row a cluster
    inertia = {r["cluster"]: int(r["n"]) for r in by}
    facts = [(k, inertia.get(k, 0), sum(inertia.values()), digest(c)) for k, c in enumerate(centroids)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # A row for each of the ``clusters`` centroids.
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


# --- the same in SQL -----------------------------------------------------------------------


def cluster_sql(settings: Settings | None = None) -> str:
    """DuckDB SQL for ``cluster_table(embeddings)``."""
    s = settings or Settings()

    def assign(n: int) -> str:
        dist = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        return f"""a{n} AS MATERIALIZED (SELECT * FROM (SELECT r, vec_id, v, k, CAST({dist} AS BIGINT) AS d FROM kept, c{n})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""

    ctes = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {s.dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, vec_id NULLS LAST, v) - 1 AS k, v AS c
  FROM (SELECT *, sha256('{s.seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept)
  QUALIFY row_number() OVER (ORDER BY h, vec_id NULLS LAST, v) <= {s.clusters})""",
        assign(0),
    ]
    for n in range(1, s.rounds + 1):
        ctes += [
            f"""m{n} AS (SELECT k, list(CAST(floor(total / n) AS BIGINT) ORDER BY j) AS c
  FROM (SELECT k, j, CAST(sum(x) AS DOUBLE) AS total, count(*) AS n
    FROM (SELECT k, unnest(v) AS x, unnest(range({s.dim})) AS j FROM a{n - 1}) GROUP BY k, j) GROUP BY k)""",
            f"c{n} AS MATERIALIZED (SELECT k, coalesce(m{n}.c, c{n - 1}.c) AS c FROM c{n - 1} LEFT JOIN m{n} USING (k))",
            assign(n),
        ]
    last = s.rounds
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(a{last}.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{last}.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (k)"""
