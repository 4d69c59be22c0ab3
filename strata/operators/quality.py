"""Data-quality checks (DQ-01..05). Each returns a DataFrame of findings so
checks run distributed and can be written like any other table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.core import c
from ..sources.lake import audited_write  # DQ-02  # noqa: F401


def missing_columns(spark: SparkSession, df: DataFrame, expected: list[str], table: str) -> DataFrame:
    """DQ-01: expected columns absent from the input (schema metadata only)."""
    missing = [n for n in expected if n not in df.columns]
    return spark.createDataFrame([(table, n) for n in missing], "tabla string, columna_faltante string")


def unmapped_values(df: DataFrame, col: str, mapping: DataFrame, map_col: str, preview: int | None = None) -> DataFrame:
    """DQ-03: all distinct values with no dictionary entry (normalised upper/trim);
    with ``preview`` only the first ones in sort order (a report to look at)."""
    m = mapping.select(F.upper(F.trim(c(map_col))).alias("__k")).distinct()
    vals = df.select(c(col).alias("valor")).filter(F.col("valor").isNotNull()).distinct()
    miss = vals.join(m, F.upper(F.trim(F.col("valor"))) == F.col("__k"), "left_anti")
    return miss if preview is None else miss.orderBy("valor").limit(preview)


def future_dates(df: DataFrame, col: str, as_of: _dt.date, tolerance_days: int = 1) -> DataFrame:
    """DQ-04: rows dated after ``as_of + tolerance`` (count, one row)."""
    limit = _dt.datetime.combine(as_of, _dt.time()) + _dt.timedelta(days=tolerance_days + 1)
    return df.agg(F.count_if(c(col) >= F.lit(limit)).alias("filas_futuras"),
                  F.count(F.lit(1)).alias("filas_total"))


def check_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """DQ-05 ``unique``: key values occurring more than once, with their count."""
    return (df.groupBy(*[c(x) for x in cols]).agg(F.count(F.lit(1)).alias("ocurrencias"))
            .filter(F.col("ocurrencias") > 1))


def check_not_null(df: DataFrame, col: str, key: str) -> DataFrame:
    """DQ-05 ``not_null``: keys of rows where ``col`` is NULL."""
    return df.filter(c(col).isNull()).select(c(key))
