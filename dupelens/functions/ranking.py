"""Dense global numbering without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_by_count(df: DataFrame, count_col: str, tie_col: str, out: str) -> DataFrame:
    """1-based position of each row by ``count_col`` descending, then by ``md5(tie_col)``, ``tie_col``.

    Rows are cut into (count, first four digits of the tie digest) cells. A cell is numbered by its own
    task; its start comes from two running sums over the cell totals: one within each count (at most
    65,536 cells) and one over the distinct counts. Group sizes add up to the row count, so N rows can
    have no more than sqrt(2 N) distinct counts: the last window stays small at any scale.
    """
    digest = F.md5(tie_col)
    cells = df.withColumn("_digest", digest).withColumn("_cell", F.substring("_digest", 1, 4))
    totals = cells.groupBy(count_col, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    within = Window.partitionBy(count_col).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    counts = totals.groupBy(count_col).agg(F.sum("_n").alias("_all"))
    above = Window.orderBy(F.desc(count_col)).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(count_col, F.coalesce(F.sum("_all").over(above), F.lit(0)).alias("_above"))
    starts = totals.join(counts, count_col).select(
        count_col, "_cell", (F.col("_above") + F.col("_before")).alias("_start")
    )
    in_cell = Window.partitionBy(count_col, "_cell").orderBy("_digest", tie_col)
    return (
        cells.withColumn("_pos", F.row_number().over(in_cell))
        .join(starts, [count_col, "_cell"])
        .withColumn(out, (F.col("_start") + F.col("_pos")).cast("bigint"))
        .drop("_digest", "_cell", "_pos", "_start")
    )
