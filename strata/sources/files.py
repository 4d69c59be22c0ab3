"""File discovery and provenance (SRC-01..04, 07..15)."""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.core import c, find_column
from ..operators.sets import union_all_by_name

# Fixed value: what the names of lock files of open workbooks begin with.
LOCK_PREFIX = "~$"


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """SRC-01 / SRC-02: Parquet scan; ``merge_schema`` unions files whose
    columns drift, by name (missing columns NULL)."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.xlsx", exclude: tuple[str, ...] = (),
               recursive: bool = False, case_insensitive: bool = True) -> DataFrame:
    """SRC-09 / SRC-10: (path, name, mtime, length) of matching files. Only file
    metadata is read (the ``content`` column of ``binaryFile`` is pruned). Lock files of open workbooks never count;
    other names are left out only if the caller gives a part of them (derived workbooks of a folder)."""
    r = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(folder).select("path", F.regexp_extract("path", r"([^/\\]+)$", 1).alias("name"),
                               F.col("modificationTime").alias("mtime"), "length")
    df = df.filter(~F.startswith(F.col("name"), F.lit(LOCK_PREFIX)))
    for ex in exclude:
        cond = F.lower("name").contains(ex.lower()) if case_insensitive else F.col("name").contains(ex)
        df = df.filter(~cond)
    return df


def with_provenance(df: DataFrame, name_col: str = "Source.Name", mtime_col: str = "Fecha_Modificacion_Archivo") -> DataFrame:
    """SRC-10: file name and modification time of the row's source file."""
    return df.withColumns({name_col: F.col("_metadata.file_name"), mtime_col: F.col("_metadata.file_modification_time")})


def latest_per_year(files: DataFrame, date_col: str, path_col: str = "path") -> DataFrame:
    """SRC-11: newest file (by the date in its name) per year; undated files skipped.
    One aggregate (``max_by`` on a (date, path) struct), no sort."""
    f = files.filter(c(date_col).isNotNull())
    return f.groupBy(F.year(c(date_col)).alias("anio")).agg(
        F.max_by(c(path_col), F.struct(c(date_col), c(path_col))).alias(path_col),
        F.max(c(date_col)).alias(date_col))


def latest_file(files: DataFrame, order_col: str = "mtime", path_col: str = "path") -> DataFrame:
    """SRC-12: the single newest file (by modification time) as a one-row DataFrame."""
    return files.agg(F.max_by(c(path_col), F.struct(c(order_col), c(path_col))).alias(path_col),
                     F.max(c(order_col)).alias(order_col))


def pending_snapshots(files: DataFrame, loaded: DataFrame, label_col: str, order_col: str) -> DataFrame:
    """SRC-13: snapshot files whose label is not loaded yet, plus the newest
    label which is always re-loaded (it may have been re-delivered)."""
    newest = files.agg(F.max_by(c(label_col), F.struct(c(order_col), c(label_col))).alias("__n"))
    todo = files.join(loaded.select(c(label_col).alias("__l")).distinct(), c(label_col) == F.col("__l"), "left_anti")
    again = files.join(F.broadcast(newest), c(label_col) == F.col("__n"), "left_semi")
    return todo.unionByName(again).distinct()


def read_folders(readers: dict[str, DataFrame], date_col: str, dates: dict[str, _dt.date | str | None]) -> DataFrame:
    """SRC-14: one DataFrame per sub-folder, each tagged with its folder's date
    column value, unioned by name."""
    parts = [df.withColumn(date_col, F.lit(dates.get(k)).cast("date")).withColumn("Carpeta", F.lit(k))
             for k, df in readers.items()]
    return union_all_by_name(*parts)


def rolling_window(col, as_of: _dt.date, days: int = 7):
    """SRC-15: rows of the last ``days`` days up to ``as_of`` (inclusive)."""
    start = _dt.datetime.combine(as_of - _dt.timedelta(days=days), _dt.time())
    end = _dt.datetime.combine(as_of + _dt.timedelta(days=1), _dt.time())
    x = c(col) if isinstance(col, str) else col
    return (x >= F.lit(start)) & (x < F.lit(end))


def read_dimension_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", sep: str = ",",
                       schema: StructType | None = None) -> DataFrame:
    """SRC-07: latin-1 CSV dimension with header; header names stripped; all
    text unless a schema is given."""
    r = spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
    df = (r.schema(schema) if schema else r).csv(path)
    return df.toDF(*[n.strip() for n in df.columns])


def read_rules(spark: SparkSession, path: str, defaults: dict[str, list]) -> dict[str, list]:
    """SRC-08: business-rule lists from a multi-line JSON object; a missing key
    takes its default. Rule files are small configuration (read once); the
    lists become CASE/IN expressions or broadcast rule tables."""
    df = spark.read.option("multiLine", True).json(path)
    row = df.limit(1).collect()
    found = row[0].asDict(recursive=True) if row else {}
    return {k: list(found.get(k) or v) for k, v in defaults.items()}


def write_rules(path: str, rules: dict[str, list]) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rules, f, ensure_ascii=False)


def column_or_default(df: DataFrame, name: str, dtype: str = "string", default=None):
    """SRC-04 re-export: schema-driven optional column."""
    from ..functions.core import col_or_default
    return col_or_default(df, name, dtype, default)


def has_column(df: DataFrame, name: str) -> bool:
    return find_column(df, name) is not None
