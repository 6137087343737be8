"""Duration blocking: gap-chained and anchored clusters.

Both rules depend on the distinct durations only, so every step works on one row per distinct duration
(with its record count) and the records are touched once, to attach their cluster.

* Gap-chained: a duration joins while it is at most ``tolerance`` above the one before it.
* Anchored: a duration joins while it is at most ``tolerance`` above the *first* of its cluster.

A cluster is named by its lowest duration, ``cluster_start``. Distinct durations are cut into range cells of about
``CELL_ROWS``, so that no task ever sees all of them. A gap above the tolerance ends clusters of either rule: durations
between two such gaps are an island. An anchored chain enters a cell at one duration of each island in it. Islands within one
cell are entered at their start; for those that reach over several cells, pointer doubling from cell to cell finds the
entries, in as many rounds as the logarithm of the cells that the longest island covers.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from dupelens.runtime import materialize

CELL_ROWS = 50_000
MOST_CELLS = 10_000


class Durations:
    """Distinct durations with their record counts, cut into cells and written once, and their checked number."""

    def __init__(self, records: DataFrame):
        seen = Observation()
        counts = records.groupBy("duration").agg(F.count(F.lit(1)).alias("n"))
        totals = F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
        counted = materialize(counts.observe(seen, *totals), "durations")
        self.distinct, self.records = seen.get["distinct"], seen.get["records"]
        self.cells = max(1, min(MOST_CELLS, math.ceil(self.distinct / CELL_ROWS)))
        self.bounds = _cell_bounds(counted, self.cells)
        self.rows = _in_cells(counted, self.bounds)


def _cell_bounds(rows: DataFrame, cells: int) -> list[float]:
    """Inner bounds of range cells that hold about equally many durations each."""
    if cells == 1:
        return []
    return sorted(set(rows.approxQuantile("duration", [i / cells for i in range(1, cells)], 0.2 / cells)))


def _in_cells(rows: DataFrame, bounds: list[float], column: str = "duration") -> DataFrame:
    """``rows`` with the number of the cell that ``column`` falls into; cells ascend with it."""
    # One cell: a border that nothing lies above, so that joins by cell stay joins by a column.
    splits = [-math.inf, *(bounds or [sys.float_info.max]), math.inf]
    placed = Bucketizer(splits=splits, inputCol=column, outputCol="_cell").transform(rows)
    return placed.withColumn("cell", F.col("_cell").cast("bigint")).drop("_cell")


def _carried(rows: DataFrame, column: str, *keys: str) -> DataFrame:
    """The last ``column`` of the cells before each cell, as ``carry``: one row per cell (and key)."""
    before = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy("cell", *keys)
        .agg(F.max(column).alias("_last"))
        .select("cell", *keys, F.last("_last", ignorenulls=True).over(before).alias("carry"))
    )


def _islands(durations: Durations, tolerances: Sequence[float]) -> DataFrame:
    """Distinct durations with the start of their island, for each tolerance: (tolerance, cell, duration, n, start)."""
    cells = durations.rows
    edges = cells.groupBy("cell").agg(F.max("duration").alias("_last"))
    below = edges.select("cell", F.lag("_last").over(Window.orderBy("cell")).alias("below"))
    inside = Window.partitionBy("cell").orderBy("duration")
    previous = F.coalesce(F.lag("duration").over(inside), F.col("below"))
    stepped = cells.join(F.broadcast(below), "cell").withColumn("previous", previous)
    tolerance = F.explode(F.array(*(F.lit(float(t)) for t in tolerances)))
    begins = F.col("previous").isNull() | (F.col("duration") > F.col("previous") + F.col("tolerance"))
    marked = stepped.withColumn("tolerance", tolerance).withColumn("mark", F.when(begins, F.col("duration")))
    so_far = Window.partitionBy("cell", "tolerance").orderBy("duration").rowsBetween(Window.unboundedPreceding, 0)
    local = marked.withColumn("local", F.last("mark", ignorenulls=True).over(so_far))
    carried = _carried(marked, "mark", "tolerance")
    return local.join(F.broadcast(carried), ["cell", "tolerance"]).select(
        "tolerance", "cell", "duration", "n", F.coalesce("local", "carry").alias("start")
    )


def _next_heads(cells: DataFrame, bounds: list[float], asked: DataFrame) -> DataFrame:
    """``asked`` (duration, reach) with the lowest duration above each reach, as ``following``, where there is one."""
    placed = _in_cells(asked, bounds, "reach").select("cell", F.col("reach").alias("at"), F.lit(1).alias("is_query"), "duration")
    points = cells.select(
        "cell", F.col("duration").alias("at"), F.lit(0).alias("is_query"), F.lit(None).cast("double").alias("duration")
    )
    # Lowest duration of the cells after each cell: one row per cell.
    every = cells.sparkSession.range(len(bounds) + 1).withColumnRenamed("id", "cell")
    lows = cells.groupBy("cell").agg(F.min("duration").alias("low"))
    after = Window.orderBy("cell").rowsBetween(1, Window.unboundedFollowing)
    upper = every.join(lows, "cell", "left").select("cell", F.min("low").over(after).alias("next_low"))
    ahead = Window.partitionBy("cell").orderBy("at", "is_query").rowsBetween(1, Window.unboundedFollowing)
    inside = F.min(F.when(F.col("is_query") == 0, F.col("at"))).over(ahead)
    return (
        points.unionByName(placed)
        .withColumn("inside", inside)
        .where("is_query = 1")
        .join(F.broadcast(upper), "cell")
        .select("duration", F.coalesce("inside", "next_low").alias("following"))
        .where("following is not null")
    )


def _last_heads(rows: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """For each duration of a cell how far the chain that enters there reaches: the last of its heads in the cell."""
    values = np.sort(rows["duration"].to_numpy())
    following = np.searchsorted(values, values + tolerance, side="right")
    last = np.arange(len(values))
    for i in range(len(values) - 1, -1, -1):
        if following[i] < len(values):
            last[i] = last[following[i]]
    return pd.DataFrame({"duration": values, "reach": values[last] + tolerance})


def _heads(rows: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """Durations of a cell with their head, from the entries of the chains; none before the first entry."""
    rows = rows.sort_values("duration")
    values, entry = rows["duration"].to_numpy(), rows["entry"].to_numpy()
    heads = np.full(len(values), np.nan)
    head, limit = np.nan, np.inf
    for i, value in enumerate(values):
        if entry[i] or value > limit:
            head, limit = value, value + tolerance
        heads[i] = head
    rows = rows[["cell", "duration", "n"]]
    return rows.assign(head=pd.Series(heads, index=rows.index).astype("float64"))


def _entries(islands: DataFrame, durations: Durations, tolerance: float) -> DataFrame:
    """(duration): where chains enter a cell. After k rounds the first 2^k cells of every island are done."""
    entries = islands.where("duration = start").select("duration")
    if durations.cells == 1:
        return entries
    spans = islands.groupBy("start").agg((F.max("cell") - F.min("cell")).alias("cells"))
    longest = spans.agg(F.max("cells")).first()[0] or 0
    if longest == 0:
        return entries
    # Only islands that go on in another cell have anything to follow.
    wide = materialize(islands.join(spans.where("cells > 0").select("start"), "start", "left_semi"), "wide-islands")
    reaches = wide.groupBy("cell").applyInPandas(lambda rows: _last_heads(rows, tolerance), "duration double, reach double")
    following = _next_heads(wide, durations.bounds, reaches)
    # A chain ends with its island.
    of_island = wide.select("duration", "start")
    jump = (
        following.join(of_island, "duration")
        .join(of_island.select(F.col("duration").alias("following"), F.col("start").alias("next_start")), "following")
        .where("start = next_start")
        .select("duration", "following")
    )
    jump = materialize(jump, "cell-jumps")
    entries = materialize(entries, "cell-entries")
    for left in range(math.ceil(math.log2(longest + 1)) - 1, -1, -1):
        reached = entries.join(jump, "duration").select(F.col("following").alias("duration"))
        entries = materialize(entries.unionByName(reached).distinct(), "cell-entries")
        if left:
            second = jump.select(F.col("duration").alias("following"), F.col("following").alias("further"))
            jump = materialize(jump.join(second, "following").select("duration", F.col("further").alias("following")), "cell-jumps")
    return entries


def _sized(starts: DataFrame) -> DataFrame:
    """Start and record count of the clusters that hold at least two records, per duration."""
    sizes = starts.groupBy("start").agg(F.sum("n").alias("cluster_size")).where("cluster_size > 1")
    return starts.join(sizes, "start").select(
        "duration", "n", F.col("start").alias("cluster_start"), "cluster_size"
    )


def gap_clusters(durations: Durations, tolerance: float = 5.0) -> DataFrame:
    """duration, n, cluster_start, cluster_size of the gap-chained clusters."""
    return _sized(_islands(durations, [tolerance]))


def anchored_clusters(durations: Durations, tolerance: float = 5.0) -> DataFrame:
    """duration, n, cluster_start, cluster_size of the anchored clusters."""
    islands = materialize(_islands(durations, [tolerance]).drop("tolerance"), "islands")
    entries = _entries(islands, durations, tolerance).withColumn("entry", F.lit(True))
    marked = islands.join(entries, "duration", "left").select(
        "cell", "duration", "n", F.coalesce("entry", F.lit(False)).alias("entry")
    )
    local = materialize(
        marked.groupBy("cell").applyInPandas(
            lambda rows: _heads(rows, tolerance), "cell bigint, duration double, n bigint, head double"
        ),
        "heads",
    ).withColumn("head", F.nanvl("head", F.lit(None)))
    placed = local.join(F.broadcast(_carried(local, "head")), "cell")
    return _sized(placed.select("duration", "n", F.coalesce("head", "carry").alias("start")))


def attach(records: DataFrame, clusters: DataFrame, durations: Durations) -> DataFrame:
    """Records of clusters with at least two records, with ``cluster_start``.

    An equi join whose hot durations adaptive execution can split.
    """
    lookup = clusters.select("duration", "cluster_start", "cluster_size")
    return records.join(lookup, "duration")


def blocking_reduction(durations: Durations, tolerances: list[float]) -> DataFrame:
    """Per tolerance: clusters and comparisons left by gap-chained blocking against all pairs, in one pass."""
    naive = durations.records * (durations.records - 1) // 2
    sizes = _islands(durations, tolerances).groupBy("tolerance", "start").agg(F.sum("n").alias("size")).where("size > 1")
    counts = sizes.groupBy("tolerance").agg(
        F.count(F.lit(1)).alias("clusters"), F.sum(F.expr("size * (size - 1) div 2")).alias("comparisons")
    )
    asked = durations.rows.sparkSession.createDataFrame([(float(t),) for t in tolerances], "tolerance double")
    # The left side is as long as the list of tolerances.
    every = asked.join(counts, "tolerance", "left").fillna(0, ["clusters", "comparisons"])
    share = (1 - F.col("comparisons") / F.lit(naive)) * 100 if naive else F.lit(0.0)
    return every.select(
        "tolerance", "clusters", "comparisons", F.lit(naive).cast("bigint").alias("naive_comparisons"), share.alias("reduction_pct")
    )


def duration_summary(records: DataFrame) -> DataFrame:
    """Range, average gap and the tolerance they suggest."""
    stats = records.agg(
        F.count(F.lit(1)).alias("files"), F.min("duration").alias("shortest"), F.max("duration").alias("longest")
    )
    spread = F.col("longest") - F.col("shortest")
    gap = F.when(F.col("files") > 1, spread / F.col("files")).otherwise(0.0)
    return stats.select(
        "files",
        "shortest",
        "longest",
        spread.alias("duration_range"),
        gap.alias("average_gap"),
        F.greatest(F.lit(10.0), gap * 2).alias("suggested_tolerance"),
    )
