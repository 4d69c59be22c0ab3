"""Set operations (SET-01..06)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.core import c


def union_all_by_name(*dfs: DataFrame) -> DataFrame:
    """SET-01 / SET-03: UNION ALL BY NAME, missing columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def relaxed_union(contract: StructType, *dfs: DataFrame) -> DataFrame:
    """SET-02: cast each input to the contract (common supertypes), then union."""
    from .shape import conform
    return union_all_by_name(*[conform(d, contract) for d in dfs])


def union_distinct(*dfs: DataFrame, ignore_cols: tuple[str, ...] = ()) -> DataFrame:
    """SET-04: full-row distinct over a by-name union. ``ignore_cols`` (D-04)
    are left out of the row identity; they come from the one row of equal ones that
    sorts first by them."""
    u = union_all_by_name(*dfs)
    keys = [n for n in u.columns if n not in ignore_cols]
    kept = [n for n in u.columns if n in ignore_cols]
    if not kept:
        return u.distinct()
    least = F.min(F.struct(*[c(n) for n in kept])).alias("__kept")
    return u.groupBy(*[c(n) for n in keys]).agg(least).select(*[c(n) if n in keys else F.col("__kept")[n].alias(n) for n in u.columns])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """SET-05."""
    return df.select(c(col)).distinct()


def value_set(*cols: tuple[DataFrame, str], out: str = "value", drop_values: tuple[str, ...] = ("NO DEFINIDA",)) -> DataFrame:
    """SET-06: union of several value columns, trimmed; blanks, NULLs and
    ``drop_values`` removed; distinct; sorted."""
    parts = [d.select(F.trim(c(n).cast("string")).alias(out)) for d, n in cols]
    u = reduce(lambda a, b: a.union(b), parts).distinct()
    return (u.filter(F.col(out).isNotNull() & (F.col(out) != "") & ~F.upper(F.col(out)).isin(*[v.upper() for v in drop_values]))
            .orderBy(out))
