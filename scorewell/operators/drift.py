"""Drift of a run's scores against the run before it.

Each run stores counts of its scores in fixed bins, one row per (column, bin).
Counts add up: those of parts of a run, or of several runs, are the sums by bin,
so they can be made where the rows are and kept when the rows are gone.  The
population-stability index of two runs is the sum over all bins of
``(p - q) * ln(p / q)``, p and q being the bins' shares in the run and in the one
before it; half a row is added to each bin, so that none is empty.

Counting is one grouping with map-side partial counts: whatever share of the rows
has one value, a task sends one row per column and bin.  The index is computed on
the counts alone, ``bins + 3`` numbers per run and column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.contracts import RUN_COLUMN, check_run_id
from scorewell.operators.checks import CHECK_COLUMNS
from scorewell.sources.catalog import read_run, refresh_run, refresh_runs, table_exists, write_run

#: Bins of NULLs (and NaN) and of values under the grid; values above it have the bin ``bins``.
NULL_BIN, LOW_BIN = -2, -1


@dataclass(frozen=True)
class Grid:
    """``bins`` bins of ``width`` from ``low`` on, for one column."""

    column: str
    low: float
    width: float
    bins: int

    def __post_init__(self):
        if self.width <= 0 or self.bins < 1:
            raise ValueError(f"grid of {self.column!r}: width and bins must be positive")

    @property
    def all_bins(self) -> int:
        return self.bins + 3

    def bin_of(self, c: Column) -> Column:
        place = (c - F.lit(float(self.low))) / F.lit(float(self.width))
        return (
            F.when(c.isNull() | F.isnan(c), NULL_BIN).when(place < 0, LOW_BIN)
            .when(place >= self.bins, self.bins).otherwise(F.floor(place)).cast("int")
        )


def histogram_contract() -> T.StructType:
    return T.StructType([
        T.StructField("column", T.StringType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField(RUN_COLUMN, T.StringType()),
    ])


def histograms(df: DataFrame, grids: Sequence[Grid], by: Sequence[str] = (RUN_COLUMN,)) -> DataFrame:
    """(by..., column, bin, n): the rows of each column in each of its bins that has any."""
    places = F.array(*[F.struct(F.lit(g.column).alias("column"), g.bin_of(F.col(g.column)).alias("bin")) for g in grids])
    rows = df.select(*by, F.inline(places))
    return rows.groupBy(*by, "column", "bin").agg(F.count(F.lit(1)).alias("n"))


def merge_histograms(*parts: DataFrame) -> DataFrame:
    """Counts of parts, added up by everything but ``n``."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*[c for c in every.columns if c != "n"]).agg(F.sum("n").alias("n"))


def stability_index(counts: Column, rows: Column, before: Column, rows_before: Column, bins: Column) -> Column:
    """The index from two maps bin -> count; NULL if one is."""
    half = F.lit(0.5)

    def share(m: Column, n: Column, b: Column) -> Column:
        return (F.coalesce(F.try_element_at(m, b), F.lit(0)) + half) / (n + half * (bins + 3))

    def add(total: Column, b: Column) -> Column:
        p, q = share(counts, rows, b), share(before, rows_before, b)
        return total + (p - q) * F.log(p / q)

    every = F.sequence(F.lit(NULL_BIN), bins)
    return F.when(before.isNotNull(), F.aggregate(every, F.lit(0.0), add))


def drift(stored: DataFrame, grids: Sequence[Grid], most: float = 0.2, digits: int = 6) -> DataFrame:
    """Per run and column: the run before it, rows, ``psi`` against it, and whether that is at most ``most``.

    Runs are in the order of their ids, as times are.  The first run of a column
    has no index and passes.  Columns without a grid are left out.
    """
    bins = F.create_map(*[x for g in grids for x in (F.lit(g.column), F.lit(g.bins))])
    mine = merge_histograms(stored.select(RUN_COLUMN, "column", "bin", "n")).where(F.col("column").isin([g.column for g in grids]))
    # A map of a column's bins, bounded by its grid; a window holds one per run.
    per = mine.groupBy(RUN_COLUMN, "column").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"), F.sum("n").alias("rows")
    )
    order = Window.partitionBy("column").orderBy(RUN_COLUMN)
    lagged = per.withColumns({f"{c}_before": F.lag(c).over(order) for c in (RUN_COLUMN, "counts", "rows")})
    psi = stability_index(F.col("counts"), F.col("rows"), F.col("counts_before"), F.col("rows_before"), bins[F.col("column")])
    found = lagged.withColumn("psi", F.round(psi, digits))
    return found.select(
        RUN_COLUMN, F.col(f"{RUN_COLUMN}_before").alias("previous_run"), "column", "rows", "psi",
        F.coalesce(F.col("psi") <= most, F.lit(True)).alias("passed"),
    )


@dataclass(frozen=True)
class DriftCheck:
    """What the daily run needs to compare itself with the one before it."""

    grids: tuple[Grid, ...]
    table: str = "score_histograms"
    most: float = 0.2


def store_histograms(scores: DataFrame, grids: Sequence[Grid], table: str, run_id: str) -> int:
    """Counts the run's ``scores`` and replaces the run's counts in ``table``."""
    counts = histograms(scores, grids, by=())
    return write_run(counts, table, run_id, contract=histogram_contract())


def drift_of_run(spark: SparkSession, table: str, run_id: str, grids: Sequence[Grid], most: float = 0.2) -> DataFrame:
    """``drift`` of one stored run, from its counts and those of the latest run before it."""
    check_run_id(run_id)
    if not table_exists(spark, table) or not refresh_run(spark, table, run_id):
        raise ValueError(f"{table} has no counts of run {run_id}")
    refresh_runs(spark, table)
    # Partition values only; a run is "before" in the order of the ids.
    last = spark.table(table).where(F.col(RUN_COLUMN) < run_id).agg(F.max(RUN_COLUMN).alias("r")).first()["r"]
    pair = read_run(spark, table, run_id)
    if last is not None:
        pair = pair.unionByName(read_run(spark, table, last))
    return drift(pair, grids, most).where(F.col(RUN_COLUMN) == run_id)


def drift_check_rows(found: DataFrame, most: float) -> DataFrame:
    """The index as check rows, one per column."""
    return found.select(
        F.lit("drift").alias("check"), F.concat(F.col("column"), F.lit(".psi")).alias("metric"),
        F.col("psi").alias("value"), F.lit(float(most)).alias("threshold"), "passed",
    ).select(*CHECK_COLUMNS)
