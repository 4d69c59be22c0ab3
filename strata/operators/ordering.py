"""Sort, limit and top-k (SRT-01/02, TOP-01..03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import as_col, c


def top_k_per_group(df: DataFrame, keys: list[str], order: list, k: int, rank_col: str = "rank") -> DataFrame:
    """TOP-01 first stage: the k best rows per group (row_number <= k). The
    window sorts within each group's partition; Spark 3.5+ pushes a group limit
    before the shuffle (WindowGroupLimit), so at most k rows per group per task move."""
    w = Window.partitionBy(*[c(x) for x in keys]).orderBy(*[as_col(o) for o in order])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def preview_values(df: DataFrame, col: str, n: int = 15) -> DataFrame:
    """TOP-02: first ``n`` distinct values in sort order (a bounded report)."""
    return df.select(c(col)).filter(c(col).isNotNull()).distinct().orderBy(c(col)).limit(n)


def top_n_filter(df: DataFrame, category: str, measure, n: int) -> DataFrame:
    """TOP-03: keep rows whose category is among the ``n`` largest by ``measure``
    (sum). The best n are found as each task's best n, merged; rows are kept by a semi join."""
    agg = df.groupBy(c(category).alias("__cat")).agg(F.sum(as_col(measure)).alias("__m"))
    top = agg.orderBy(F.col("__m").desc(), F.col("__cat").asc()).limit(n).select("__cat")
    return df.join(F.broadcast(top), c(category) == F.col("__cat"), "left_semi")
