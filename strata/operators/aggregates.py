"""Aggregations (AGG-01..21). Every grouping is a regular ``groupBy`` so Spark
does partial (map-side) aggregation before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach_scalar
from pyspark.sql.types import NumericType

from ..functions.core import as_col, c


def ordered_concat(value, order_by: list, sep: str = "; ", distinct: bool = True) -> Column:
    """AGG-09 / AGG-10: values joined in order of appearance.

    ``collect_list`` order is undefined after a shuffle, so (order keys, value)
    structs are collected and sorted; ``distinct`` keeps first appearances.
    The collected list is bounded by the group size: use on grouped, not global, data."""
    v = as_col(value).cast("string")
    keys = [as_col(o) for o in order_by]
    s = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], v.alias("v"))
    arr = F.transform(F.array_sort(F.collect_list(F.when(v.isNotNull(), s))), lambda x: x["v"])
    if distinct:
        arr = F.array_distinct(arr)
    return F.array_join(arr, sep)


def first_appearance_concat(df: DataFrame, keys: list, value, order_by: list, sep: str = "; ",
                            out: str = "valores") -> DataFrame:
    """AGG-09 at scale: distinct values per group joined in order of first
    appearance, as two aggregations. (1) first appearance per (group, value):
    a regular aggregate with map-side combine, so a hot group costs one row
    per distinct value per task; (2) per group, sort the (first, value) pairs
    and join. Memory per group is bounded by its number of distinct values,
    not by its rows. Returns (keys..., out)."""
    kcols = [as_col(k) for k in keys]
    knames = [k if isinstance(k, str) else f"__k{i}" for i, k in enumerate(keys)]
    v = as_col(value).cast("string")
    firsts = (df.select(*[kc.alias(kn) for kc, kn in zip(kcols, knames)], v.alias("__v"),
                        F.struct(*[as_col(o).alias(f"o{i}") for i, o in enumerate(order_by)]).alias("__o"))
              .filter(F.col("__v").isNotNull())
              .groupBy(*[c(k) for k in knames], "__v").agg(F.min("__o").alias("__first")))
    pairs = F.array_sort(F.collect_list(F.struct(F.col("__first"), F.col("__v"))))
    return firsts.groupBy(*[c(k) for k in knames]).agg(F.array_join(F.transform(pairs, lambda x: x["__v"]), sep).alias(out))


def share_of_total(df: DataFrame, value: str, out: str = "share", pct: bool = True, scale: int | None = None) -> DataFrame:
    """AGG-14: value / grand total. Intended for aggregated (small) inputs; the
    grand total is a separate global aggregate joined as one row, not a
    single-partition window over the rows."""
    tot = df.agg(F.sum(c(value)).alias("__tot"))
    x = c(value) / F.col("__tot") * (100.0 if pct else 1.0)
    if scale is not None:
        x = F.round(x, scale)
    return attach_scalar(df, tot).withColumn(out, x).drop("__tot")


def fixed_width_histogram(df: DataFrame, col: str, width: float, lo: float = 0.0, out_label: str = "bin",
                          label_fmt=None) -> DataFrame:
    """AGG-18: ``[lo + k*w, lo + (k+1)*w)`` bins labelled ``'a a b'`` style
    (``"lo a lo+w-1"``); empty bins never appear (grouping only creates seen bins)."""
    k = F.floor((c(col) - F.lit(lo)) / F.lit(width))
    start = F.lit(lo) + k * F.lit(width)
    g = (df.filter(c(col).isNotNull()).withColumn("bin_start", start.cast("long"))
         .groupBy("bin_start").agg(F.count(F.lit(1)).alias("n")))
    label = F.concat_ws(" a ", F.col("bin_start").cast("string"),
                        (F.col("bin_start") + F.lit(int(width) - 1)).cast("string"))
    return g.withColumn(out_label, label_fmt(F.col("bin_start")) if label_fmt else label)


def equal_width_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """AGG-19: ``bins`` equal-width bins between the column min and max. The
    min/max come from one global aggregate (one row) joined back."""
    mm = df.agg(F.min(c(col)).alias("__lo"), F.max(c(col)).alias("__hi"))
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(
        F.least(F.floor((c(col) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins) + 1, F.lit(bins)))
    return (attach_scalar(df.filter(c(col).isNotNull()), mm).withColumn("bucket", b.cast("int"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                   F.min(c(col)).alias("lo"), F.max(c(col)).alias("hi")))


def numeric_means(df: DataFrame, scale: int | None = None) -> DataFrame:
    """AGG-17: mean of every numeric column in one pass."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    exprs = [F.avg(c(n)) for n in cols]
    if scale is not None:
        exprs = [F.round(e, scale) for e in exprs]
    return df.agg(*[e.alias(f"avg_{n}") for e, n in zip(exprs, cols)])


def profile(df: DataFrame, cols: list[str], accuracy: int = 10_000, exact_distinct: bool = False) -> DataFrame:
    """AGG-16: per column count, distinct, mean, stddev, min, quartiles, max; one row for each column.

    One scan and one aggregate for all columns: quantile sketches (rank error at most count / ``accuracy``) and
    distinct sketches (relative error about 2 %) are merged from the tasks' partial ones, then the single row is
    stacked. ``exact_distinct`` counts by value instead, which expands each row once for each column."""
    aggs, fields = [], []
    for i, n in enumerate(cols):
        x = c(n)
        numeric = isinstance(df.schema[n].dataType, NumericType)
        xd = x.cast("double") if numeric else F.lit(None).cast("double")
        parts = {
            "count": F.count(x), "unique": F.count_distinct(x) if exact_distinct else F.approx_count_distinct(x, 0.02),
            "mean": F.avg(xd), "std": F.stddev_samp(xd), "min": F.min(xd),
            "quartiles": F.percentile_approx(xd, [0.25, 0.5, 0.75], accuracy), "max": F.max(xd)}
        aggs += [v.alias(f"{k}_{i}") for k, v in parts.items()]
        fields.append(F.struct(F.lit(n).alias("column"), *[F.col(f"{k}_{i}").alias(k) for k in parts]))
    return df.agg(*aggs).select(F.inline(F.array(*fields)))
