"""Tables that change partition by partition (MRG-01, MRG-02, MRG-05, STR-01): a batch reads and writes only the
partitions it touches.

* ``replace_keys``: the table is partitioned by the merge key (a date, a period label). The batch's keys are
  overwritten by Spark's dynamic partition overwrite; rows without a key are a partition of their own, which is
  merged (distinct) with the batch's rows without a key.
* ``append_new_rows``: the table is partitioned by a bucket of the row's hash. Of the buckets that the batch touches
  only the hashes are read; rows that are not there yet are appended, nothing is rewritten.

Both are idempotent: the same batch again leaves the table as it is, so a replayed or retried batch does no harm.
Columns may drift: readers merge the files' schemas, columns that a file lacks are NULL; a merge reads no file, not
even a footer, outside its partitions. Hidden columns (``__part``, ``__h1``, ``__h2``) are dropped by ``read_table``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.core import c, rows_counted
from ..operators.sets import union_distinct
from ..operators.windows import keep_latest, row_tiebreak

PART, HASHES = "__part", ("__h1", "__h2")
#: Partitions of a table without a merge key.
BUCKETS = 64


def _nothing_there(spark: SparkSession, path: str) -> bool:
    """Whether the folder is missing, by the file system of the path; False where that cannot be asked."""
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): reading tells
        return False


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its hidden columns; None if nothing was written there yet."""
    if _nothing_there(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table_exists(spark: SparkSession, path: str) -> bool:
    return _stored(spark, path) is not None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    df = _stored(spark, path)
    if df is None:
        raise FileNotFoundError(path)
    return df.drop(PART, *HASHES)


def _key_partition(key: str) -> Column:
    """Partition of a key, as text that is never taken for a number or a date; ``n`` for rows without a key."""
    return F.when(c(key).isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), c(key).cast("string")))


def _write(df: DataFrame, path: str, mode: str) -> int:
    """Rows written, as Spark counts them on the way."""
    counted = Observation("written")
    # rebalance: one file of fair size for a small partition, several tasks for a hot one
    rows = df.observe(counted, F.count(F.lit(1)).alias("n")).hint("rebalance", PART)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return rows_counted(counted)


def replace_keys(spark: SparkSession, path: str, batch: DataFrame, key: str) -> int:
    """MRG-01 / MRG-05: the rows of every key of the batch are replaced; other keys' partitions are neither read nor
    written. The first load is distinct (MRG-03). Returns the rows written."""
    rows = (batch.distinct() if _nothing_there(spark, path) else batch).withColumn(PART, _key_partition(key))
    undated = rows.filter(F.col(PART) == "n")
    before = None if undated.isEmpty() else _stored(spark, f"{path}/{PART}=n")
    if before is not None:
        merged = union_distinct(before, undated.drop(PART)).withColumn(PART, F.lit("n"))
        rows = rows.filter(F.col(PART) != "n").unionByName(merged, allowMissingColumns=True)
    return _write(rows, path, "overwrite")


def replace_labels(spark: SparkSession, path: str, batch: DataFrame, label: str, id_col: str, order_cols: list[str]) -> int:
    """MRG-05: as ``replace_keys`` by period label, the batch reduced to the last row of each (label, id)."""
    return replace_keys(spark, path, keep_latest(batch, [label, id_col], order_cols, tie_break=row_tiebreak(batch)), label)


def _row_hashes(df: DataFrame, ignore_cols: tuple[str, ...]) -> DataFrame:
    """128 bits of each row over its columns by name; NULLs do not count, so that a column more does not change a row
    that lacks it."""
    names = sorted(n for n in df.columns if n not in ignore_cols)
    filled = [F.when(c(n).isNotNull(), F.struct(F.lit(n), c(n).cast("string"))) for n in names]
    return df.withColumns({h: F.xxhash64(F.lit(i), *filled) for i, h in enumerate(HASHES)})


def _hashes(spark: SparkSession, path: str, touched: list[str]) -> DataFrame:
    schema = ", ".join([*(f"{h} bigint" for h in HASHES), f"{PART} string"])
    return spark.read.schema(schema).parquet(path).filter(F.col(PART).isin(touched)).select(*HASHES)


def append_new_rows(spark: SparkSession, path: str, batch: DataFrame, ignore_cols: tuple[str, ...] = (), buckets: int = BUCKETS) -> int:
    """MRG-02: rows of the batch that the table does not hold yet are appended, each once (``ignore_cols`` do not make
    a row another one; the row that came first stays). Of the table only the hashes in the touched buckets are read. Returns the rows written."""
    rows = _row_hashes(union_distinct(batch.limit(0), batch, ignore_cols=ignore_cols), ignore_cols)
    rows = rows.withColumn(PART, F.concat(F.lit("b"), F.pmod(F.col(HASHES[0]), F.lit(buckets)).cast("string")))
    if not _nothing_there(spark, path):
        touched = [r[0] for r in rows.select(PART).distinct().collect()]  # as many as there are buckets at most
        rows = rows.join(_hashes(spark, path, touched), list(HASHES), "left_anti")
    return _write(rows, path, "append")
