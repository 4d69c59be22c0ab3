"""Joins (JON-01..10 building blocks).

No side is broadcast by hint: the planner measures shuffled sides at run time and
broadcasts the small ones, by bytes. The one exception is a one-row aggregate
(``attach_scalar``), which is one row by construction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import as_col, c


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (a grand total, a max key) to
    every row: broadcast equi-join on a constant key (the right side is one
    row by construction)."""
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one").drop("__one")


def left_latest(detail: DataFrame, lookup: DataFrame, key: str, lookup_key: str, agg_cols: dict[str, Column],
                norm=None) -> DataFrame:
    """JON-01: pre-aggregate the right side to one row per (normalised) key, then
    left join. The pre-aggregation makes the join 1:1 (and shrinks the shuffle)."""
    normf = norm or (lambda x: x)
    right = (lookup.withColumn("__k", normf(c(lookup_key)))
             .filter(F.col("__k").isNotNull())
             .groupBy("__k").agg(*[e.alias(n) for n, e in agg_cols.items()]))
    return (detail.withColumn("__k", normf(c(key)))
            .join(right, "__k", "left").drop("__k"))


def attach_sk(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str, unknown: int = -1) -> DataFrame:
    """JON-02 / KEY-01: fact -> dimension surrogate key, unmatched = ``unknown``.
    The dimension has one row per key (the smallest surrogate key) so the join never
    multiplies facts."""
    d = dim.select(c(dim_key).alias("__dk"), c(sk).alias("__sk")).groupBy("__dk").agg(F.min("__sk").alias("__sk"))
    out = fact.join(d, c(fact_key) == F.col("__dk"), "left")
    return out.withColumn(sk, F.coalesce(F.col("__sk"), F.lit(unknown).cast("long"))).drop("__dk", "__sk")


def map_enrich(df: DataFrame, mapping: DataFrame, key: str, map_key: str, value_cols: dict[str, str],
               default: str = "Sin Asignar", fallback_col: str | None = None, order_col: str | None = None) -> DataFrame:
    """JON-04: dictionary enrichment on ``upper(trim(key))``.

    ``value_cols`` maps dictionary column -> output column. Duplicated dictionary
    keys: the last row by ``order_col`` wins, all attributes from that one row; without
    ``order_col`` the row whose attributes sort last. Unmatched rows and NULL attributes
    get ``default``, except ``fallback_col`` (output name), which keeps the original key
    where there is no match."""
    m = mapping.withColumn("__mk", F.upper(F.trim(c(map_key)))).filter(F.col("__mk").isNotNull())
    values = F.struct(*[c(k).alias("__v_" + v) for k, v in value_cols.items()])
    last = F.max(F.struct(*([c(order_col).alias("__o")] if order_col else []), values.alias("__v")))
    m = m.groupBy("__mk").agg(last.alias("__last")).select("__mk", "__last.__v.*", F.lit(True).alias("__hit"))
    out = df.withColumn("__mk", F.upper(F.trim(c(key)))).join(m, "__mk", "left")
    for _, v in value_cols.items():
        missing = F.when(F.col("__hit"), F.lit(default)).otherwise(c(key)) if fallback_col == v else F.lit(default)
        out = out.withColumn(v, F.coalesce(F.col("__v_" + v), missing))
    return out.drop("__mk", "__hit", *["__v_" + v for v in value_cols.values()])


def outer_with_indicator(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                         indicator: str = "_merge") -> DataFrame:
    """JON-06: full outer join with a ``both``/``left_only``/``right_only`` column."""
    l2 = left.withColumn("__l", F.lit(True))
    r2 = right.withColumn("__r", F.lit(True))
    j = l2.join(r2, c(left_key) == r2[right_key], "full_outer")
    ind = (F.when(F.col("__l") & F.col("__r"), "both").when(F.col("__l"), "left_only").otherwise("right_only"))
    return j.withColumn(indicator, ind).drop("__l", "__r")


def right_only(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JON-06 short form: rows of ``right`` with no partner in ``left``."""
    return right.join(left.select(c(left_key).alias("__k")).distinct(), as_col(right_key) == F.col("__k"),
                      "left_anti")
