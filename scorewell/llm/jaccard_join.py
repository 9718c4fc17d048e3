"""Exact join of documents whose shingle sets have a Jaccard similarity of at least 0.9.

The Jaccard distance d = 1 - similarity is a metric, and the join works in that
metric space; r is the largest distance of a link.

1. Sets.  A document becomes the set of its 3-word shingles (64-bit hashes).
   Documents with the same set are one point.
2. Regions.  Under any fixed order of all shingles, two sets within r share a
   shingle among the first n - ceil(0.9 n) + 1 of each.  Every such shingle that
   several points have opens a region with those points; regions with the same
   points are one, and points whose sizes differ too much for a link come
   apart: at steps of size that no link crosses, or, for a shingle of very many
   points, by ranges of size that overlap, so that no task sorts all its points.
   Frequent shingles come last in the order, so that passages
   found everywhere open regions only for documents made of little else.  (Which
   shingles count as frequent changes the work, never the result.)
3. Sketches.  A region's points are first held against each other by sketches:
   how many of a set's shingles fall into each of some buckets of hashes.  Two
   sets differ in at least as many shingles as the sum of the differences of
   their buckets, and if that is more than linked sets may differ in, they aren't
   linked.  Points that this doesn't part, directly or through others, form a
   cluster; every link lies in one.
4. Voronoi recursion.  A cluster with more than ``Settings.cap`` points draws
   pivots among its points.  Each point goes to its nearest pivot's region and, by
   the triangle inequality, to that of every other pivot p with
   d(x, p) <= d(x, nearest) + 2 r: any link then has a region with both ends.  This
   repeats until regions are small or splitting would copy most points.
5. Dense regions, as those of many near copies, aren't compared pair by pair.  What
   links with the same pivot is one component already, so pivots are drawn in rounds
   among the points that aren't connected with most of their region yet, and held
   against all its points.  Only what stays apart after the last round is compared
   with all points, block by block.  Regions of step 2 that are too large for one task
   are treated alike, by sketches.
6. Small regions are compared completely, by exact intersections, and give the
   edges of a spanning forest of their links, at most one a point.
7. Components (of clusters and of links) by large-star and small-star steps.

Every step's unit has a bounded number of points; no group is collected whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import BLOCK_BYTES, SPACED, blank_text, free_prefix, mix, slices, tidy, utf8, words, written


@dataclass(frozen=True)
class Settings:
    width: int = 3
    #: Two points are linked if 100 * intersection >= percent * union.
    percent: int = 90
    #: Points that are compared in one task.
    cap: int = 128
    pivots: int = 8
    depth: int = 4
    #: Rounds of pivots in dense regions, each with twice as many as the one before; they
    #: end sooner where a round leaves more than half of what was apart.
    rounds: int = 4
    #: Documents in one slice of a partition that make a shingle worth counting, occurrences in
    #: all slices that make it frequent, and how many frequent ones are used at most.
    local: int = 3
    frequent: int = 48
    most_frequent: int = 1 << 20
    #: Points (in all slices) beyond which a shingle's points are dealt over many tasks.
    wide: int = 1 << 12
    #: Sets of n shingles have about n / 2 ** sketch_bits buckets in their sketch.
    sketch_bits: int = 4
    #: Points of a region that are held against its pivots in one task.
    chunk: int = 256
    #: Rows of two numbers that are sent to every executor rather than shuffling all texts to them.
    broadcast_rows: int = 1 << 20

    @property
    def radius(self) -> float:
        return 1 - self.percent / 100


# --- sets ----------------------------------------------------------------------------------------


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    h, _, _, first = words(*utf8(column), SPACED)
    n = np.diff(first)
    with np.errstate(over="ignore"):
        sh = np.zeros(max(len(h) - width + 1, 0), np.uint64)
        for k in range(width):
            sh = (sh ^ h[k : k + len(sh)]) * np.uint64(0x9DDFEA08EB382D69)
            sh ^= sh >> np.uint64(31)
        sh = mix(sh)
        out = []
        for a, m in zip(first[:-1].tolist(), n.tolist(), strict=True):
            if m >= width:
                out.append(np.unique(sh[a : a + m - width + 1]))
            elif m:  # the whole sequence as one
                v = np.uint64(m)
                for w in h[a : a + m]:
                    v = (v ^ w) * np.uint64(0x9DDFEA08EB382D69)
                    v ^= v >> np.uint64(31)
                out.append(mix(np.array([v])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def point_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def keyed(docs: DataFrame) -> DataFrame:
    """(key, tx, text): a document's id, smallest number for null, and its text's hash."""
    text = blank_text(F.col("text"))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("key"), F.xxhash64(text).alias("tx"), text.alias("text")
    )


MARKS = "key bigint, tx bigint, n bigint, node bigint, sketch binary, token bigint, times bigint"
_MARKS = pa.schema(
    [*((c, pa.int64()) for c in ("key", "tx", "n", "node")), ("sketch", pa.binary()), ("token", pa.int64()), ("times", pa.int64())]
)


def prefix_size(n: int, s: Settings) -> int:
    """How many of n shingles, under any order, hold one that every linked set has among its own first ones."""
    return n - -(-s.percent * n // 100) + 1


def sketch_of(x: np.ndarray, s: Settings) -> bytes:
    """How many hashes of a set, 255 at most, have the same first bits; buckets by the size of the set."""
    bits = max(0, len(x).bit_length() - s.sketch_bits)
    if not bits:
        return bytes([min(len(x), 255)])
    return np.minimum(np.bincount((x >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def mark(rows: DataFrame, s: Settings) -> DataFrame:
    """A row per document (key, tx, n, node, sketch; the last two are null for an empty
    set), and rows (token, times) for shingles that several points of a slice have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 * BLOCK_BYTES):
                sets = shingle_sets(part.column("text"), s.width)
                nodes = [point_of(x) if len(x) else None for x in sets]
                n = [len(x) for x in sets]
                distinct = {k: x for k, x in zip(nodes, sets, strict=True) if k is not None}
                every = np.sort(np.concatenate([*distinct.values(), np.zeros(0, np.uint64)]))
                edge = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
                times = np.diff(np.append(edge, len(every)))
                often = times >= s.local
                tokens, times = every[edge[often]].view(np.int64), times[often]
                nulls = lambda k, kind=pa.int64(): pa.nulls(k, kind)
                sketches = [sketch_of(x, s) if len(x) else None for x in sets]
                a, b = part.num_rows, len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(c) for c in (
                        [part.column("key"), nulls(b)], [part.column("tx"), nulls(b)], [pa.array(n, pa.int64()), nulls(b)],
                        [pa.array(nodes, pa.int64()), nulls(b)], [pa.array(sketches, pa.binary()), nulls(b, pa.binary())],
                        [nulls(a), pa.array(tokens)], [nulls(a), pa.array(times, pa.int64())],
                    )], schema=_MARKS,
                )

    return written(rows.mapInArrow(tidy(run), MARKS), "jaccard-marks")


# --- regions ---------------------------------------------------------------------------------------


def prefixes(rows: DataFrame, order: np.ndarray, wide: np.ndarray, s: Settings) -> DataFrame:
    """(token, node, n, wide) for the first shingles of each point; a point may repeat.

    ``order``: frequent shingles, the rarest first; they follow all others.
    ``wide``: those of very many points.
    """
    known = np.sort(order)
    rank = np.argsort(order, kind="stable")  # place in ``order`` of each of ``known``

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                seen, tokens, nodes, sizes = set(), [], [], []
                for x in shingle_sets(part.column("text"), s.width):
                    if not len(x) or (node := point_of(x)) in seen:
                        continue
                    seen.add(node)
                    take = prefix_size(len(x), s)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                        hot = known[at] == x
                        late = x[hot][np.argsort(rank[at[hot]], kind="stable")]
                        x = np.concatenate([x[~hot], late])
                    tokens.append(x[:take])
                    nodes.append(np.full(take, node))
                    sizes.append(np.full(take, len(x)))
                if tokens:
                    every = np.concatenate(tokens)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(every.view(np.int64)), pa.array(np.concatenate(nodes), pa.int64()),
                         pa.array(np.concatenate(sizes), pa.int32()), pa.array(np.isin(every, wide))], names=["token", "node", "n", "wide"],
                    )

    return rows.select("text").mapInArrow(tidy(run), "token bigint, node bigint, n int, wide boolean")


def wide_regions(first: DataFrame, s: Settings) -> DataFrame:
    """(region, node, size) as ``regions`` gives them, for shingles of any number of points.

    Sizes fall into classes so wide that linked ones are in the same or in
    neighbouring classes; a region is two neighbouring classes of a shingle.
    Rows are dealt by shingle and point, and a region's description is summed
    per task before it is shuffled.
    """
    # a little wider than the ratio of linked sizes, for the rounding of logarithms
    size_class = F.floor(F.log(F.col("n")) / F.lit(1.01 * math.log(100 / s.percent)))
    dealt = written(
        first.dropDuplicates(["token", "node"]).withColumn("c", size_class)
        .select("token", "node", F.explode(F.array("c", F.col("c") - 1)).alias("part")),
        "jaccard-wide",
    )
    whole = written(
        dealt.groupBy("token", "part").agg(
            F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("x"),
        ).where("size > 1"),
        "jaccard-wide-regions",
    )
    return dealt.join(_to_all(whole, s), ["token", "part"]).select(
        F.xxhash64("low", "high", "size", "x").alias("region"), "node", "size"
    )


def _to_all(rows: DataFrame, s: Settings) -> DataFrame:
    """Written rows, to be broadcast while there are few; beyond that skewed joins are split at run time."""
    return F.broadcast(rows) if rows.count() <= s.broadcast_rows else rows


def regions(first: DataFrame, any_wide: bool, s: Settings) -> DataFrame:
    """(region, node, size): points that share a prefix shingle, each set of points once.

    Linked sets differ little in size (the smaller has 0.9 of the larger's
    shingles or more), so a shingle's points, sorted by size, come apart at
    every step that is too large: nothing links across it.  Shingles marked wide
    are left to ``wide_regions``.
    """
    if any_wide:
        first = written(first, "jaccard-prefixes")
    w = Window.partitionBy("token")
    up = w.orderBy("n", "node")
    w_part = Window.partitionBy("token", "part")
    step = F.coalesce(100 * F.lag("n").over(up) < s.percent * F.col("n"), F.lit(False))
    rows = (
        first.where("NOT wide").repartition("token").dropDuplicates(["token", "node"])
        .withColumn("size", F.count(F.lit(1)).over(w)).where("size > 1")
        .withColumn("step", step).withColumn("part", F.sum(F.col("step").cast("int")).over(up))
        .withColumn("low", F.min("node").over(w_part)).withColumn("high", F.max("node").over(w_part))
        .withColumn("size", F.count(F.lit(1)).over(w_part)).withColumn("x", F.bit_xor(F.xxhash64("node")).over(w_part))
        .where("size > 1")
    )
    rows = rows.select(F.xxhash64("low", "high", "size", "x").alias("region"), "node", "size")
    if any_wide:
        rows = rows.unionByName(wide_regions(first.where("wide"), s))
    return written(rows.dropDuplicates(["region", "node"]), "jaccard-regions")


SETS = "node bigint, n bigint, tokens binary"


def sets_of(rows: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """(node, n, tokens) of the wanted points, from one document each (key, tx)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part.column("text"), s.width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([point_of(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "n", "tokens"],
                )

    # (key, tx) is 16 bytes: up to this many it can go to every executor
    near_by = F.broadcast(wanted) if wanted.count() <= s.broadcast_rows else wanted
    texts = rows.join(near_by, ["key", "tx"]).select("key", "tx", "text").dropDuplicates(["key", "tx"])
    return written(texts.select("text").mapInArrow(tidy(run), SETS), "jaccard-sets")


# --- comparing ---------------------------------------------------------------------------------------


def as_sets(tokens: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(t, np.uint64) for t in tokens]


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    m = len(sets)
    row = np.repeat(np.arange(m), [len(x) for x in sets])
    uniq, at, n = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
    shared = n > 1
    place = np.cumsum(shared) - 1
    keep = shared[at]
    row, col = row[keep], place[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((m, m), np.int64)
    for k in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(col, [k, k + columns])
        x = np.zeros((m, columns), np.float32)
        x[row[a:b], col[a:b] - k] = 1
        out += (x @ x.T).astype(np.int64)
    out[np.arange(m), np.arange(m)] = [len(x) for x in sets]
    return out


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    both, n = intersections(sets), np.array([len(x) for x in sets])
    return 100 * both >= percent * (n[:, None] + n[None] - both)


def forest(links: np.ndarray) -> np.ndarray:
    """Of each point, the smallest point that it is connected to."""
    root = np.arange(len(links))
    while True:
        new = np.where(links, root[None], len(links)).min(axis=1)
        new = np.minimum(new, root)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def distance(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 1 - both / (len(x) + len(y) - both)


def differences(sketches: list[np.ndarray]) -> np.ndarray:
    """For each pair, the sum of the differences of their buckets: no more than the sets differ in.

    Where the numbers of buckets differ, neighbouring ones of the longer sketch are added up.
    """
    sizes = np.array([len(x) for x in sketches])
    out = np.zeros((len(sketches), len(sketches)), np.int64)
    for size in np.unique(sizes):
        longer = np.flatnonzero(sizes >= size)
        # 255 stands for 255 and more, also in what is added up
        folded = np.stack([np.minimum(sketches[k].reshape(size, -1).sum(axis=1, dtype=np.int32), 255) for k in longer])
        for k in np.flatnonzero(sizes[longer] == size):
            d = np.abs(folded - folded[k]).sum(axis=1)
            out[longer[k], longer] = d
            out[longer, longer[k]] = d
    return out


def may_link(sketches: list[np.ndarray], n: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that aren't ruled out: linked sets differ in at most (100 - p) / (100 + p) of the sum of their sizes."""
    return differences(sketches) * (100 + percent) <= (100 - percent) * (n[:, None] + n[None])


def sketches_meet(x: list[bytes], n: np.ndarray, y: list[bytes], m: np.ndarray, percent: int) -> np.ndarray:
    """``may_link`` for each sketch of one list and each of another."""
    fold = lambda t, size: np.minimum(t.reshape(*t.shape[:-1], size, -1).sum(axis=-1, dtype=np.int32), 255)
    lengths, out = np.array([len(t) for t in x]), np.zeros((len(x), len(y)), bool)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        mine = np.stack([np.frombuffer(x[k], np.uint8) for k in at])
        for k, theirs in enumerate(y):
            size = min(int(length), len(theirs))
            d = np.abs(fold(mine, size) - fold(np.frombuffer(theirs, np.uint8), size)).sum(axis=1)
            out[at, k] = d * (100 + percent) <= (100 - percent) * (n[at] + m[k])
    return out


def sets_link(x: list[bytes], n: np.ndarray, y: list[bytes], m: np.ndarray, percent: int, columns: int = 4096) -> np.ndarray:
    """``linked`` for each set of one list and each of another."""
    mine, theirs = as_sets(x), as_sets(y)
    known, col_y = np.unique(np.concatenate(theirs), return_inverse=True)
    row_y = np.repeat(np.arange(len(y)), [len(t) for t in theirs])
    every = np.concatenate(mine)
    col_x = np.minimum(np.searchsorted(known, every), len(known) - 1)
    row_x = np.repeat(np.arange(len(x)), [len(t) for t in mine])
    shared = known[col_x] == every
    row_x, col_x = row_x[shared], col_x[shared]
    ends = np.arange(0, len(known) + columns, columns)
    both = np.zeros((len(x), len(y)), np.int64)
    cells = []
    for row, col in ((row_x, col_x), (row_y, col_y)):
        order = np.argsort(col, kind="stable")
        cells.append((row[order], col[order], np.searchsorted(col[order], ends)))
    for k in range(len(ends) - 1):
        parts = []
        for (row, col, cut), size in zip(cells, both.shape, strict=True):
            part = np.zeros((size, columns), np.float32)
            part[row[cut[k] : cut[k + 1]], col[cut[k] : cut[k + 1]] - ends[k]] = 1
            parts.append(part)
        both += (parts[0] @ parts[1].T).astype(np.int64)
    return 100 * both >= percent * (n[:, None] + m[None] - both)


def by_region(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each region, from batches that are sorted by region."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        region = rows.column("region").to_numpy()
        cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist()]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield rows.slice(a, b - a)
        held = rows.slice(cuts[-1]) if len(region) else None
    if held is not None and held.num_rows:
        yield held


def _grouped(members: DataFrame) -> DataFrame:
    return members.repartition("region").sortWithinPartitions("region", "node")


def _distinct(rows: pa.Table) -> pa.Table:
    node = rows.column("node").to_numpy()
    return rows if (node[1:] != node[:-1]).all() else rows.take(np.flatnonzero(np.append(True, node[1:] != node[:-1])))


EDGES = "u bigint, v bigint"


def near(members: DataFrame, s: Settings) -> DataFrame:
    """Edges (u, v) that connect the points of each region that sketches don't part; (region, node, n, sketch), regions of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_region(batches):
            rows = _distinct(rows)
            node = rows.column("node").to_numpy()
            sketches = [np.frombuffer(x, np.uint8) for x in rows.column("sketch").to_pylist()]
            yield _edges(node, forest(may_link(sketches, rows.column("n").to_numpy(), s.percent)))

    return _grouped(members).mapInArrow(tidy(run), EDGES)


def _edges(node: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    moved = root != np.arange(len(root))
    return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["u", "v"])


def compare(members: DataFrame, s: Settings) -> DataFrame:
    """Edges (u, v) that connect the linked points of each region; (region, node, tokens), regions of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_region(batches):
            rows = _distinct(rows)
            node = rows.column("node").to_numpy()
            yield _edges(node, forest(linked(as_sets(rows.column("tokens").to_pylist()), s.percent)))

    return _grouped(members).mapInArrow(tidy(run), EDGES)


# --- Voronoi recursion -------------------------------------------------------------------------------

SPREAD = "region bigint, node bigint, pivot bigint, d double, home boolean"


def spread(members: DataFrame, sets: DataFrame, level: int, s: Settings) -> DataFrame:
    """(region, node, pivot, d, home): for each point its nearest pivot and those within the window.

    Pivots are drawn by hash, about ``pivots`` of each region; a region's points
    are dealt out in chunks, and its pivots go to each chunk.
    """
    draw = F.pmod(F.xxhash64("region", "node", F.lit(level)), F.lit(1 << 30))
    chunks = F.ceil(F.col("size") / F.lit(s.chunk)).cast("int")
    drawn = members.where(draw < F.lit(float(s.pivots << 30)) / F.col("size"))
    pivots = drawn.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).join(sets, "node").select(
        *[F.col(c).alias(f"pivot_{c}") for c in ("region", "chunk", "node", "tokens")]
    )
    points = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int")).join(sets, "node").select(
        *[F.col(c).alias(c) for c in ("region", "chunk", "node", "tokens")]
    )

    def run(x: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        out = []
        p = p.sort_values("pivot_node")
        if len(x) and len(p):
            mine, theirs, names = as_sets(x["tokens"].tolist()), as_sets(p["pivot_tokens"].tolist()), p["pivot_node"].to_numpy()
            for region, node, tokens in zip(x["region"], x["node"], mine, strict=True):
                d = np.array([distance(tokens, y) for y in theirs])
                home = int(d.argmin())
                # a little more than 2 r, for the rounding of the distances
                for k in np.flatnonzero(d <= d[home] + 2 * s.radius + 1e-9).tolist():
                    out.append((region, node, int(names[k]), float(d[k]), k == home))
        return pd.DataFrame(out, columns=["region", "node", "pivot", "d", "home"])

    both = points.groupBy("region", "chunk").cogroup(pivots.groupBy("pivot_region", "pivot_chunk"))
    return written(both.applyInPandas(run, SPREAD), "jaccard-spread")


def blocks(members: DataFrame, cap: int) -> DataFrame:
    """(region, node): cells of two blocks of about ``cap`` points each, which hold every pair of points of a region
    of which one is ``apart`` (all are, where there is no such column)."""
    if "apart" not in members.columns:
        members = members.withColumns({"apart": F.lit(True), "n_apart": F.col("size")})
    hashed = F.xxhash64("node", "region")
    count = lambda n: F.ceil(F.col(n) / F.lit(cap)).cast("int")
    one, two = F.col("one"), F.col("two")  # the block of the point that is apart, and of the other
    both_apart = F.col("n_apart") == F.col("size")  # then the cells (1, 2) and (2, 1) are one
    own = F.pmod(hashed, count("n_apart"))
    first = members.where("apart").select(
        "*", own.alias("one"), F.explode(F.sequence(F.lit(0), count("size") - 1)).alias("two")
    )
    second = members.where("n_apart < size").select(
        "*", F.explode(F.sequence(F.lit(0), count("n_apart") - 1)).alias("one"), F.pmod(hashed, count("size")).alias("two")
    ).where(~F.col("apart") | (F.col("one") != own))  # its own cells hold it already
    return first.unionByName(second).select(
        F.xxhash64(
            "region", F.when(both_apart, F.least(one, two)).otherwise(one), F.when(both_apart, F.greatest(one, two)).otherwise(two)
        ).alias("region"), "node",
    )


def spanning(met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of entries that connect all that the matrix connects: each row's first, others only if they join columns."""
    root, keep, last, base = list(range(met.shape[1])), [], -1, -1

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for row, column in np.argwhere(met).tolist():
        if row != last:
            last, base = row, column
            keep.append((row, column))
        elif (a := find(base)) != (b := find(column)):
            root[a] = b
            keep.append((row, column))
    at = np.array(keep, np.int64).reshape(-1, 2)
    return at[:, 0], at[:, 1]


Meets = Callable[[list[bytes], np.ndarray, list[bytes], np.ndarray, int], np.ndarray]
STARS = "region bigint, node bigint, pivot bigint"


def stars(members: DataFrame, values: DataFrame, meets: Meets, level: int, s: Settings) -> DataFrame:
    """(region, node, pivot): a pivot of this round that each point of a region meets, and more where they connect pivots.

    Pivots are drawn by hash among the points that are apart, about ``pivots`` of
    each region and twice as many in each round; points are dealt out in chunks.
    """
    draw = F.pmod(F.xxhash64("region", "node", F.lit(level), F.lit("star")), F.lit(1 << 30))
    chunks = F.ceil(F.col("size") / F.lit(s.chunk)).cast("int")
    drawn = members.where("apart").where(draw < F.lit(float(s.pivots << (30 + level))) / F.col("n_apart"))
    pivots = drawn.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).join(values, "node").select(
        *[F.col(c).alias(f"pivot_{c}") for c in ("region", "chunk", "node", "n", "value")]
    )
    points = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int")).join(values, "node").select(
        "region", "chunk", "node", "n", "value"
    )

    def run(x: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        met = np.zeros((len(x), len(p)), bool)
        if len(x) and len(p):
            met = meets(x["value"].tolist(), x["n"].to_numpy(), p["pivot_value"].tolist(), p["pivot_n"].to_numpy(), s.percent)
        at, to = spanning(met)
        return pd.DataFrame({c: f[k].to_numpy()[i] for c, f, k, i in (
            ("region", x, "region", at), ("node", x, "node", at), ("pivot", p, "pivot_node", to)
        )})

    both = points.groupBy("region", "chunk").cogroup(pivots.groupBy("pivot_region", "pivot_chunk"))
    return written(both.applyInPandas(run, STARS), "jaccard-stars")


def star_roots(found: DataFrame, s: Settings) -> DataFrame:
    """(region, node, root) of each point that met a pivot: the smallest of the pivots it is connected with."""
    first = found.groupBy("region", "node").agg(F.min("pivot").alias("first"))
    # pivots with a point in common: no more than pairs of pivots of a region
    pairs = found.join(first, ["region", "node"]).select("region", "first", "pivot").distinct()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names, at = np.unique(rows[["first", "pivot"]].to_numpy(), return_inverse=True)
        links, at = np.eye(len(names), dtype=bool), at.reshape(-1, 2)
        links[at[:, 0], at[:, 1]] = links[at[:, 1], at[:, 0]] = True
        return pd.DataFrame({"region": rows["region"].iloc[0], "first": names, "root": names[forest(links)]})

    of_pivot = written(pairs.groupBy("region").applyInPandas(run, "region bigint, first bigint, root bigint"), "jaccard-star-roots")
    return first.join(_to_all(of_pivot, s), ["region", "first"]).select("region", "node", "root")


def dense(members: DataFrame, values: DataFrame, meets: Meets, s: Settings) -> tuple[list[DataFrame], DataFrame]:
    """Edges that connect points of large regions, and cells (region, node) with all pairs that may connect more.

    ``members`` is (region, node, size), ``values`` (node, n, value).  Points that
    the edges found so far connect need no comparison.  So a region's points are
    apart only if they aren't in the component that holds most of them; pivots of the
    next round come from those, and what is apart at the end is compared with all
    points of its region.  Regions with none apart are done.
    """
    rows = written(members.select("region", "node", "size", F.lit(True).alias("apart"), F.col("size").alias("n_apart")), "jaccard-dense")
    found: list[DataFrame] = []
    before = rows.count()
    for level in range(s.rounds):
        if not before:
            break
        found.append(stars(rows, values, meets, level, s))
        named = rows.join(star_roots(_union(found), s), ["region", "node"], "left").select(
            "region", "node", "size", F.coalesce("root", "node").alias("root")
        )
        most = written(
            named.groupBy("region", "root").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("region").agg(F.max_by("root", F.struct("k", "root")).alias("main"), (F.sum("k") - F.max("k")).alias("n_apart"))
            .where("n_apart > 0"),
            "jaccard-most",
        )
        rows = written(
            named.join(_to_all(most, s), "region")
            .select("region", "node", "size", (F.col("root") != F.col("main")).alias("apart"), "n_apart"),
            "jaccard-dense",
        )
        left = rows.where("apart").count()
        if 2 * left > before:
            break
        before = left
    edges = [f.where("node != pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")) for f in found]
    most_apart = 2 * F.col("n_apart") > F.col("size")  # then all pairs of blocks, each once, are fewer
    rows = rows.withColumns({"apart": F.col("apart") | most_apart, "n_apart": F.when(most_apart, F.col("size")).otherwise(F.col("n_apart"))})
    return edges, blocks(rows, s.cap)


def small_regions(rows: DataFrame, sets: DataFrame, s: Settings) -> tuple[list[DataFrame], DataFrame]:
    """Edges, and (region, node) of bounded regions that hold both ends of all links of the given regions but for
    those between points that the edges connect."""
    done, whole = [rows.where(F.col("size") <= s.cap).select("region", "node")], []
    left = written(rows.where(F.col("size") > s.cap), "jaccard-large")
    for level in range(s.depth):
        if left.isEmpty():
            break
        moved = spread(left, sets, level, s)
        # A split is worth it if it copies few points; regions that drew no pivot stay whole.
        worth = moved.groupBy("region").agg(
            (F.count(F.lit(1)) <= 1.5 * F.count(F.when(F.col("home"), 1))).alias("worth")
        )
        judged = written(left.join(worth, "region", "left").withColumn("worth", F.coalesce("worth", F.lit(False))), "jaccard-judged")
        whole.append(judged.where(~F.col("worth")).select("region", "node", "size"))
        split = moved.join(judged.where("worth").select("region", "node"), ["region", "node"]).select(
            F.xxhash64("region", "pivot", F.lit(level)).alias("region"), "node"
        )
        counts = written(split.groupBy("region").agg(F.count(F.lit(1)).alias("size")), "jaccard-sizes")
        split = written(split.join(counts, "region"), "jaccard-split")
        done.append(split.where(F.col("size") <= s.cap).select("region", "node"))
        left = written(split.where(F.col("size") > s.cap), "jaccard-large")
    whole.append(left.select("region", "node", "size"))
    edges, cells = dense(_union(whole), sets.withColumnRenamed("tokens", "value"), sets_link, s)
    return edges, _union([*done, cells])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- components --------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge: the smallest node of its component.

    Alternates large-star and small-star steps, each of which hangs a node's
    neighbours on its smallest one, until nothing moves.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "jaccard-low")
        moved = (both.where("v > u") if large else both).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            moved = moved.unionByName(low.select("u", F.col("m").alias("v")))
        return moved.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    e = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "jaccard-edges")
    while True:
        size = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        e = written(star(written(star(e, True), "jaccard-large-star"), False), "jaccard-edges")
        if e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first() == size:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )


# --- the join ------------------------------------------------------------------------------------------


def grouped(docs: DataFrame, s: Settings) -> DataFrame:
    """(key, tx, n, node, low): each document with the smallest (key, tx) of its component.

    ``low`` is null for an empty set, which is linked with nothing.
    """
    rows = keyed(docs)
    marks = mark(rows, s)
    hot = (
        marks.where("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times"))
        .where(F.col("times") >= s.frequent).orderBy(F.desc("times"), "token").limit(s.most_frequent)
        .toArrow().sort_by([("times", "ascending"), ("token", "ascending")])
    )
    order = hot.column("token").combine_chunks().to_numpy().view(np.uint64) if hot.num_rows else np.zeros(0, np.uint64)
    docs_ = marks.where("key IS NOT NULL")
    marks = docs_.select("key", "tx", "n", "node")
    wide = np.sort(order[hot.column("times").to_numpy() >= s.wide])
    found = regions(prefixes(rows, order, wide, s), len(wide) > 0, s)
    lows = written(marks.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("key", "tx")).alias("low")), "jaccard-lows")

    stands = lambda nodes: lows.join(nodes, "node").select("low.key", "low.tx")

    # Regions by sketches; then clusters by sets.  A point's sketch is that of the document that stands for it.
    sketches = written(
        docs_.join(written(stands(found.select("node").distinct()), "jaccard-stands"), ["key", "tx"])
        .select("node", "n", "sketch").dropDuplicates(["node"]),
        "jaccard-sketches",
    )
    close, cells = dense(found.where(F.col("size") > s.cap), sketches.withColumnRenamed("sketch", "value"), sketches_meet, s)
    cells = written(found.where(F.col("size") <= s.cap).select("region", "node").unionByName(cells), "jaccard-cells")
    clusters = written(components(_union([near(cells.join(sketches, "node"), s), *close])), "jaccard-clusters")
    sizes = written(clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "jaccard-sizes")
    members = written(clusters.join(sizes, "root").select(F.col("root").alias("region"), "node", "size"), "jaccard-members")
    sets = sets_of(rows, written(stands(members.select("node")), "jaccard-wanted"), s)
    links, small = small_regions(members, sets, s)
    small = written(small, "jaccard-small")
    # (region, node) is 16 bytes: while there are few, the sets move once, to their regions
    few = F.broadcast(small) if small.count() <= s.broadcast_rows else small
    edges = compare(sets.select("node", "tokens").join(few, "node"), s)
    comp = written(components(_union([edges, *links])), "jaccard-components")
    tops = written(
        comp.join(lows, "node").groupBy("root").agg(F.min("low").alias("top")), "jaccard-tops"
    )
    named = written(comp.join(tops, "root").select("node", "top"), "jaccard-named")
    of_node = written(
        lows.join(named, "node", "left").select("node", F.coalesce("top", "low").alias("low")), "jaccard-of-node"
    )
    return marks.join(of_node, "node", "left")


def _id(key: Column) -> Column:
    return F.when(key != -(2**63), key)


def component_table(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Null and empty texts have the empty set and are their own component.  Rows
    with equal sets are linked; a null id counts as the smallest number among
    ids and is given as null.  Other columns play no part.
    """
    g = grouped(docs, settings or Settings())
    return g.select(_id(F.col("key")).alias("doc_id"), F.col("n").alias("n_shingles"),
                    _id(F.coalesce("low.key", "key")).alias("component_id"))


def one_of_each(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents with one of each component: that with the smallest id, then the smallest hash of the text.

    Of rows that share both, one stays.  Documents with an empty set all stay.
    """
    g = grouped(docs, settings or Settings())
    p = free_prefix(docs, "jaccard_")
    stay = written(
        g.where("low IS NULL OR (low.key = key AND low.tx = tx)").select(
            F.col("key").alias(f"{p}key"), F.col("tx").alias(f"{p}tx"), F.col("low").isNull().alias(f"{p}empty")
        ).distinct(),
        "jaccard-stay",
    )
    own = docs.withColumns({
        f"{p}key": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))), f"{p}tx": F.xxhash64(blank_text(F.col("text"))),
    })
    kept = own.join(stay, [f"{p}key", f"{p}tx"])
    return (
        kept.where(~F.col(f"{p}empty")).dropDuplicates([f"{p}key", f"{p}tx"]).select(*docs.columns)
        .unionByName(kept.where(f"{p}empty").select(*docs.columns))
    )
