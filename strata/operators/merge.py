"""Incremental merges of bronze history with a new batch (MRG-01..07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import c
from .sets import union_all_by_name, union_distinct
from .windows import keep_latest, row_tiebreak


def upsert_by_key(history: DataFrame, batch: DataFrame, key: str, strict_reference: bool = False) -> DataFrame:
    """MRG-01 / MRG-05: history rows whose ``key`` value occurs in the batch are
    replaced by the batch (union by name, missing columns NULL).

    Replacement is a ``left_anti`` join on the distinct batch keys (no literal
    IN-list). Undated history rows (NULL key) are kept and de-duplicated
    against undated batch rows, so re-running the same batch is idempotent
    (D-01). ``strict_reference=True`` reproduces ``NOT IN``: when the batch has
    a key, every NULL-key history row disappears."""
    keys = batch.select(c(key).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    dated_hist = history.filter(c(key).isNotNull()).join(keys, c(key) == F.col("__k"), "left_anti").drop("__k")
    dated_batch = batch.filter(c(key).isNotNull())
    if strict_reference:
        has_keys = keys.limit(1).count() > 0
        undated_hist = history.filter(c(key).isNull()).limit(0) if has_keys else history.filter(c(key).isNull())
        return union_all_by_name(dated_hist, undated_hist, batch)
    undated = union_distinct(history.filter(c(key).isNull()), batch.filter(c(key).isNull()))
    return union_all_by_name(dated_hist, dated_batch, undated)


def upsert_by_date(history: DataFrame, batch: DataFrame, date_col: str, strict_reference: bool = False) -> DataFrame:
    """MRG-01."""
    return upsert_by_key(history, batch, date_col, strict_reference)


def append_distinct(history: DataFrame, batch: DataFrame, ignore_cols: tuple[str, ...] = ()) -> DataFrame:
    """MRG-02: no merge key -> append then full-row distinct (D-04 ``ignore_cols``)."""
    return union_distinct(history, batch, ignore_cols=ignore_cols)


def initial_load(batch: DataFrame) -> DataFrame:
    """MRG-03: first load = distinct rows."""
    return batch.distinct()


def consolidate(*parts: DataFrame) -> DataFrame:
    """MRG-04: raw consolidation, diagonal concat (no dedupe)."""
    return union_all_by_name(*parts)


def upsert_by_label(history: DataFrame, batch: DataFrame, label_col: str, id_col: str,
                    order_cols: list[str]) -> DataFrame:
    """MRG-05: snapshot replace by period label; the batch is first reduced to
    the last row per (label, id) under ``order_cols`` (descending)."""
    b = keep_latest(batch, [label_col, id_col], order_cols, tie_break=row_tiebreak(batch))
    return upsert_by_key(history, b, label_col)


def newest_version(df: DataFrame, keys: list[str], mtime_col: str = "Fecha_Modificacion_Archivo",
                   drop_meta: bool = True) -> DataFrame:
    """MRG-07: CDC order, the row from the newest file wins per key; ties by full row."""
    out = keep_latest(df, keys, [mtime_col], tie_break=row_tiebreak(df, exclude=(mtime_col,)))
    return out.drop(mtime_col) if drop_meta else out
