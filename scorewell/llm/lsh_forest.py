"""Approximate nearest neighbours with a hash-prefix forest.

Each tree gives every vector a hash string of 64 bits (on which side of a
random hyperplane it lies, 64 times, each plane through the median of a bounded
sample) and keeps the strings sorted.  A query descends in each tree to the
rows with the longest common prefix, by binary search in the sorted array;
then all trees ascend together, one bit at a time, until the rows found in any
of them number ``Settings.reach`` of all rows.  These candidates are ranked by
their exact distance.

Vectors are dealt over shards, each with the sorted arrays of its own rows for
every tree and the same hash functions, so a vector is stored once.  The trees
of a shard are built where its rows are, and queries go to the shards in
blocks of bounded size; the level at which a query stops is decided on the
counts of all shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import written

BITS = 64


@dataclass(frozen=True)
class Settings:
    trees: int = 32
    #: Share of all rows that a query's candidates number at least.
    reach: float = 0.5
    nearest: int = 10
    shard: int = 8192
    #: Rows that the planes' medians are taken from, in expectation, and queries sent at once.
    sample: int = 4096
    block: int = 16_384
    seed: int = 3


@dataclass
class Planes:
    normals: np.ndarray  # trees x dimension x bits
    middle: np.ndarray  # trees x bits

    def strings(self, x: np.ndarray) -> np.ndarray:
        """Hash strings, trees x rows, the first bit highest."""
        out = np.zeros((len(self.normals), len(x)), np.uint64)
        for t, (normal, middle) in enumerate(zip(self.normals, self.middle, strict=True)):
            bits = (x @ normal > middle).astype(np.uint8)
            out[t] = np.packbits(bits, axis=1).reshape(-1, 8).view(">u8").ravel()
        return out


def usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def planes_for(rows: DataFrame, dim: int, n: int, s: Settings) -> Planes:
    rng = np.random.default_rng(s.seed)
    normals = rng.standard_normal((s.trees, dim, BITS))
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))
    sample = rows.where(place < min(1.0, s.sample / max(n, 1)) * (1 << 20)).select("vec").toArrow().column("vec")
    if len(sample):
        x = np.stack([v.values.to_numpy() for v in sample])
        return Planes(normals, np.median(x @ normals, axis=1))
    return Planes(normals, np.zeros((s.trees, BITS)))


# --- index --------------------------------------------------------------------------------------

INDEX = "rows int, ids binary, vectors binary, strings binary, places binary"
_INDEX = pa.schema([("rows", pa.int32()), *((c, pa.binary()) for c in ("ids", "vectors", "strings", "places"))])


def build_index(rows: DataFrame, planes: Planes, dim: int, n: int, s: Settings) -> DataFrame:
    """A row per shard: its vectors, and for each tree the sorted strings and whose they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, s.shard):
                part = batch.slice(at, s.shard)
                x = part.column("vec").flatten().to_numpy().reshape(-1, dim)
                strings = planes.strings(x)
                places = np.argsort(strings, axis=1, kind="stable").astype("<i4")
                yield pa.RecordBatch.from_pylist([{
                    "rows": len(x), "ids": part.column("vec_id").to_numpy().astype("<i8").tobytes(),
                    "vectors": x.astype("<f8").tobytes(),
                    "strings": np.take_along_axis(strings, places, axis=1).astype("<u8").tobytes(), "places": places.tobytes(),
                }], _INDEX)

    dealt = rows.select("vec_id", "vec").repartition(max(1, -(-n // s.shard)))
    return written(dealt.mapInArrow(run, INDEX), "forest-index")


@dataclass
class Shard:
    ids: np.ndarray
    vectors: np.ndarray
    strings: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, row: dict, trees: int) -> Shard:
        n = row["rows"]
        return cls(
            np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(n, -1),
            np.frombuffer(row["strings"], "<u8").reshape(trees, n), np.frombuffer(row["places"], "<i4").reshape(trees, n),
        )

    def prefixes(self, strings: np.ndarray, least: int = 1) -> np.ndarray:
        """For each row, the longest prefix (of ``least`` bits or more, else 0) it has in common with a query in any tree."""
        best = np.zeros(len(self.ids), np.uint8)
        levels = np.arange(least, BITS + 1, dtype=np.uint64)
        low_bits = np.where(levels == BITS, np.uint64(0), np.uint64(2**64 - 1) >> np.minimum(levels, BITS - 1))
        for mine, sorted_, places in zip(strings, self.strings, self.places, strict=True):
            low = np.searchsorted(sorted_, mine & ~low_bits, "left")
            high = np.searchsorted(sorted_, mine | low_bits, "right")
            for k in range(len(levels)):  # ascending in length: ranges nest and shrink
                if low[k] == high[k]:
                    break
                if k + 1 < len(levels) and low[k] == low[k + 1] and high[k] == high[k + 1]:
                    continue
                at = places[low[k] : high[k]]
                best[at] = np.maximum(best[at], np.uint8(levels[k]))
        return best


# --- search -------------------------------------------------------------------------------------


def search(vectors: DataFrame, is_query: Column, settings: Settings | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest rows found for each query.

    ``vectors`` has vec_id and embedding.  Rows with a null id, an unusable
    vector, or a dimension other than the most frequent one take no part.
    Queries with the same id are one (the smallest vector counts); rows with a
    query's id aren't its neighbours.  Equal distances rank by the smaller vec_id;
    repeated rows are found each.  Other columns play no part.  Without rows or
    queries the result is empty.
    """
    s = settings or Settings()
    spark = vectors.sparkSession
    kinds = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"), is_query.alias("query")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    sizes = kinds.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("dim")).head(1)
    if not top:
        return spark.createDataFrame([], RESULT)
    dim, n = top[0]["dim"], top[0]["n"]
    rows = kinds.where(F.size("vec") == dim)
    planes = planes_for(rows, dim, n, s)
    index = build_index(rows, planes, dim, n, s)
    asked = written(rows.where("query").groupBy("vec_id").agg(F.min("vec").alias("vec")), "forest-queries")
    blocks = max(1, -(-asked.count() // s.block))
    found = None
    for b in range(blocks):  # a block of queries against all shards
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow()
        if part.num_rows:
            q = part.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            near = _search_block(index, part.column("vec_id").to_numpy(), q, planes, n, s)
            found = near if found is None else found.unionByName(near)
    if found is None:
        return spark.createDataFrame([], RESULT)
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= s.nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


RESULT = "query_id bigint, rank int, vec_id bigint, score double"


#: Queries that meet all rows of a shard in one matrix product.
QUERIES = 256


def squares(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared distances, rows x queries, up to rounding; for each query a bound of twice that rounding)."""
    xx, qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
    with np.errstate(over="ignore", invalid="ignore"):
        found = xx[:, None] - 2 * (x @ q.T) + qq
        slack = 1e-12 * x.shape[1] * (xx.max(initial=0.0) + qq)
    # Beyond what doubles hold, nothing is left out.
    sound = np.isfinite(found).all(axis=0) & np.isfinite(slack)
    return np.where(sound, found, 0.0), np.where(sound, slack, np.inf)


def _search_block(index: DataFrame, ids: np.ndarray, q: np.ndarray, planes: Planes, n: int, s: Settings) -> DataFrame:
    """The nearest of each shard for each query of a block."""
    spark = index.sparkSession
    strings = planes.strings(q)  # trees x queries

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, of = Shard.of(row, s.trees), np.zeros((len(ids), BITS + 1), np.int64)
                for k in range(len(ids)):
                    of[k] = np.bincount(shard.prefixes(strings[:, k]), minlength=BITS + 1)
                at, level = np.nonzero(of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), pa.array(level, pa.int32()), pa.array(of[at, level], pa.int64())], names=["at", "level", "n"]
                )

    # All trees ascend level by level until enough rows are reached.
    counts = index.select("rows", "ids", "vectors", "strings", "places").mapInArrow(count, "at int, level int, n bigint")
    total = np.zeros((len(ids), BITS + 1), np.int64)
    table = counts.groupBy("at", "level").agg(F.sum("n").alias("n")).toArrow()
    total[table.column("at").to_numpy(), table.column("level").to_numpy()] = table.column("n").to_numpy()
    reached = np.cumsum(total[:, ::-1], axis=1)[:, ::-1]  # rows with a prefix of this length or longer
    want = int(np.ceil(s.reach * n))
    stop = (reached >= max(want, min(n, s.nearest + 1))).sum(axis=1) - 1  # the longest level that has them

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, out = Shard.of(row, s.trees), []
                for k, query in enumerate(ids.tolist()):
                    if k % QUERIES == 0:  # all rows against a block of queries in one product
                        rough = squares(shard.vectors, q[k : k + QUERIES])
                    least = int(stop[k])
                    near = shard.prefixes(strings[:, k], max(least, 1)) >= least
                    at = np.flatnonzero(near & (shard.ids != query))
                    if not len(at):
                        continue
                    if len(at) > s.nearest:
                        # The product rounds; whatever may be among the nearest is measured exactly.
                        r, slack = rough[0][at, k % QUERIES], rough[1][k % QUERIES]
                        at = at[r <= np.partition(r, s.nearest - 1)[s.nearest - 1] + slack]
                    d = np.sqrt(((shard.vectors[at] - q[k]) ** 2).sum(axis=1))
                    best = np.lexsort((shard.ids[at], d))[: s.nearest]
                    out.append((np.full(len(best), query), shard.ids[at[best]], d[best]))
                if out:
                    cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                        names=["query_id", "vec_id", "score"],
                    )

    return written(index.mapInArrow(rank, "query_id bigint, vec_id bigint, score double"), "forest-near")


def nearest_table(embeddings: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The ten nearest rows of each row whose vec_id is divisible by 100."""
    return search(embeddings, F.col("vec_id") % 100 == 0, settings)
