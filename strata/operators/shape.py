"""Projection and schema shaping (PRJ-01..08)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.core import c, find_column


def clean_headers(df: DataFrame, mode: str = "strip") -> DataFrame:
    """PRJ-01: strip (always), then optionally ``upper`` or ``title`` case the names."""
    def fix(n: str) -> str:
        n = n.strip()
        if mode == "upper":
            return n.upper()
        if mode == "title":
            return n.title()
        return n
    return df.toDF(*[fix(n) for n in df.columns])


def dedupe_columns(df: DataFrame) -> DataFrame:
    """PRJ-03: keep the first of each repeated column name (positional)."""
    seen, tmp, keep = set(), [], []
    for i, n in enumerate(df.columns):
        t = f"__pos{i}"
        tmp.append(t)
        if n not in seen:
            seen.add(n)
            keep.append((t, n))
    d = df.toDF(*tmp)
    return d.select(*[c(t).alias(n) for t, n in keep])


def rename_synonyms(df: DataFrame, synonyms: dict[str, list[str]]) -> DataFrame:
    """PRJ-02: for each target, the present source names (target first, then
    synonyms in order; case-insensitive) are coalesced into the target and the
    sources removed, so no duplicate (or case-only different) names appear."""
    out = df
    for target, names in synonyms.items():
        present = []
        for n in [target] + list(names):
            f = find_column(out, n)
            if f is not None and f not in present:
                present.append(f)
        if not present:
            continue
        merged = F.coalesce(*[c(p) for p in present]) if len(present) > 1 else c(present[0])
        rest = [c(n) for n in out.columns if n not in present]
        out = out.select(*rest, merged.alias(target))
    return out


def drop_unnamed(df: DataFrame, patterns: tuple[str, ...] = (r"^Unnamed", r"^Col_\d+$")) -> DataFrame:
    """PRJ-04: drop placeholder columns from sheet/HTML exports."""
    rx = [re.compile(p) for p in patterns]
    return df.select(*[c(n) for n in df.columns if not any(r.search(n) for r in rx)])


def conform(df: DataFrame, contract: StructType | list[str]) -> DataFrame:
    """PRJ-05: fixed ordered output: missing -> typed NULL, extras dropped,
    present columns (matched ignoring case and outer spaces) cast to the
    contract type and renamed to the contract's spelling."""
    if isinstance(contract, StructType):
        fields = [(f.name, f.dataType) for f in contract.fields]
    else:
        fields = [(n, None) for n in contract]
    cols = []
    for name, dtype in fields:
        found = name if name in df.columns else find_column(df, name)  # Spark resolves names case-insensitively
        if found is not None:
            x = c(found)
            cols.append((x.cast(dtype) if dtype is not None else x).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype or "string").alias(name))
    return df.select(*cols)


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """PRJ-06: constant column."""
    return df.withColumn(name, F.lit(value))


def exclude(df: DataFrame, *cols: str) -> DataFrame:
    """PRJ-07: ``SELECT * EXCLUDE (...)``."""
    return df.drop(*cols)
