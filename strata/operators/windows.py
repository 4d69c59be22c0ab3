"""Window operators (WIN-01..11): keep-latest / keep-first dedupes, lead,
partition counts, frequency dense rank, running share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach_scalar

from ..functions.core import as_col, c
from ..session import cut_lineage


def _order(order: list) -> list[Column]:
    return [as_col(o) for o in order]


def keep_first(df: DataFrame, keys: list[str], order: list, tie_break: list | None = None) -> DataFrame:
    """WIN-01..06: one row per key, the first under ``order`` (+ ``tie_break``).

    Callers pass a total order (file mtime, then row columns) so the survivor is
    deterministic (D-07/D-08). NULL keys form one group, like pandas
    ``drop_duplicates``. Shuffles once on ``keys``; AQE splits skewed keys."""
    w = Window.partitionBy(*[c(k) for k in keys]).orderBy(*(_order(order) + _order(tie_break or [])))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def keep_latest(df: DataFrame, keys: list[str], by: list[str], tie_break: list | None = None,
                nulls_last: bool = True) -> DataFrame:
    """WIN-01/02/03: latest row per key by ``by`` descending (NULLs last)."""
    order = [c(b).desc_nulls_last() if nulls_last else c(b).desc_nulls_first() for b in by]
    return keep_first(df, keys, order, tie_break)


def time_bucket(df: DataFrame, col: str, unit: str | None = "month") -> Column | None:
    """``date_trunc(unit, col)`` when ``col`` is a date/timestamp, else ``None``
    (no bucketing) - the bucket used by the skew-safe lead."""
    if not unit:
        return None
    t = df.schema[col].dataType.simpleString() if col in df.columns else ""
    return F.date_trunc(unit, c(col)) if t in ("date", "timestamp", "timestamp_ntz") else None


def _flip(o) -> Column:
    """Reverse an ascending sort key given as a name or column."""
    if isinstance(o, str):
        return c(o).desc()
    raise ValueError("reverse=True needs column names in ``order``")


def row_tiebreak(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[Column]:
    """Full-row tie breaker: every column ascending, NULLs first."""
    return [c(n).asc_nulls_first() for n in df.columns if n not in exclude]


def next_value(df: DataFrame, partition: list[str], order: list, value: str, out: str, offset: int = 1,
               bucket=None, reverse: bool = False) -> DataFrame:
    """WIN-07: ``shift(-1)`` inside a partition = ``lead``.

    ``bucket`` (a column expression monotone in the first order key, e.g. the
    month of the timestamp) makes it skew-safe: the lead runs inside
    (partition, bucket) windows, and the last row of each bucket takes the first
    value of the next non-empty bucket from a per-bucket table (one row per key
    and bucket). A hot key is then sorted by many tasks instead of one.
    ``reverse=True`` gives the previous value (``lag``) the same way."""
    ords = _order(order)
    if reverse:
        ords = [_flip(o) for o in order]
    if bucket is None:
        w = Window.partitionBy(*[c(p) for p in partition]).orderBy(*ords)
        return df.withColumn(out, F.lead(c(value), offset).over(w))
    if offset != 1:
        raise ValueError("bucketed next_value supports offset=1")
    keys = [c(p) for p in partition]
    b = df.withColumn("__b", bucket if not isinstance(bucket, str) else c(bucket))
    order_struct = F.struct(*[o.alias(f"o{i}") if not isinstance(o, str) else c(o).alias(f"o{i}")
                              for i, o in enumerate(order)])
    inner = Window.partitionBy(*keys, F.col("__b")).orderBy(*ords)
    b = b.withColumn("__in", F.lead(c(value)).over(inner)).withColumn("__last", F.lead(F.lit(1)).over(inner).isNull())
    pick = F.max_by if reverse else F.min_by
    firsts = b.groupBy(*keys, F.col("__b")).agg(pick(c(value), order_struct).alias("__first"))
    per_key = Window.partitionBy(*keys).orderBy(F.col("__b").desc() if reverse else F.col("__b"))
    nxt = firsts.withColumn("__next", F.lead("__first").over(per_key)).drop("__first")
    # NULL keys are one group, as in the window: the join back must match them too
    nxt = nxt.toDF(*[f"__k{i}" for i in range(len(keys))], "__kb", "__next")
    on = b["__b"].eqNullSafe(F.col("__kb"))
    for i, p in enumerate(partition):
        on = on & c(p).eqNullSafe(F.col(f"__k{i}"))
    j = b.join(nxt, on, "left").drop("__kb", *[f"__k{i}" for i in range(len(keys))])
    return j.withColumn(out, F.when(F.col("__last"), F.col("__next")).otherwise(F.col("__in"))).drop("__b", "__in", "__last", "__next")


def count_over(df: DataFrame, partition: list[str], out: str, value: str | None = None) -> DataFrame:
    """WIN-08: group count attached to each row (``transform('count')``).

    Computed as an aggregate (partial, map-side) joined back on the keys rather
    than a partition window: a window buffers a hot group in one task, while the
    join lets AQE split a skewed partition. NULL keys form one group (null-safe
    join), like the window."""
    keys = [c(p) for p in partition]
    agg = df.groupBy(*[k.alias(f"__g{i}") for i, k in enumerate(keys)]).agg(
        F.count(c(value) if value else F.lit(1)).alias(out))
    cond = None
    for i, k in enumerate(keys):
        e = k.eqNullSafe(F.col(f"__g{i}"))
        cond = e if cond is None else cond & e
    return df.join(agg, cond, "left").drop(*[f"__g{i}" for i in range(len(keys))])


def frequency_rank(df: DataFrame, col: str, out: str) -> DataFrame:
    """WIN-09: dense rank of a category by frequency (1 = most frequent);
    NULL/blank -> 0. The rank runs over the distinct frequencies: n rows have at most
    sqrt(2 n) of them, however many categories there are. Categories take their
    frequency's rank, and rows their category's, by joins."""
    x = F.nullif(F.trim(c(col)), F.lit(""))
    counts = (df.select(x.alias("__cat")).filter(F.col("__cat").isNotNull())
              .groupBy("__cat").agg(F.count(F.lit(1)).alias("__n")))
    ranks = counts.select("__n").distinct().withColumn(out, F.dense_rank().over(Window.orderBy(F.col("__n").desc())))
    ranked = counts.join(ranks, "__n").drop("__n")
    return (df.withColumn("__cat", x).join(ranked, "__cat", "left")
            .withColumn(out, F.coalesce(c(out), F.lit(0))).drop("__cat"))


def running_total(df: DataFrame, value, order: list, out: str) -> DataFrame:
    """Running sum of ``value`` under a total order, as a distributed prefix scan: rows are dealt by ranges of the
    order, each range sums its own rows, and adds the totals of the ranges before it (one row for each range). The
    dealt rows are checkpointed, so that both uses see the same ranges after an executor loss."""
    keys = _order(order)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *keys).withColumns({"__pid": F.spark_partition_id(), "__v": as_col(value)}))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__pid").agg(F.sum("__v").alias("__t"))
    offsets = totals.select("__pid", F.sum("__t").over(before).alias("__off"))
    own = Window.partitionBy("__pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranged.withColumn("__run", F.sum("__v").over(own)).join(offsets, "__pid")
            .withColumn(out, F.col("__run") + F.coalesce("__off", F.lit(0))).drop("__pid", "__v", "__run", "__off"))


def running_share(df: DataFrame, value: str, order: list, out: str = "cum_pct", scale: int | None = None) -> DataFrame:
    """WIN-10: running cumulative % of the total under a total order (a prefix scan)."""
    tot = df.agg(F.sum(c(value)).alias("__tot"))
    x = F.col("__run_total") / F.col("__tot") * 100.0
    if scale is not None:
        x = F.round(x, scale)
    return attach_scalar(running_total(df, value, order, "__run_total"), tot).withColumn(out, x).drop("__tot", "__run_total")
