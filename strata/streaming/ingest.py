"""STR-01 / STR-02: exactly-new-files ingestion.

Each file is taken once (the checkpoint's file log). STR-01 replaces the partitions of the batch's dates; a replayed
batch replaces them with the same rows. STR-02 keeps the newest row of each key in Spark's state store: a batch
reads its own rows and the state of their keys, and writes only the keys whose newest row has changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.core import c
from ..sources.partitioned import append_new_rows, replace_keys

BATCH = "__batch"


def file_stream(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, options: dict | None = None) -> DataFrame:
    """Streaming file source with an explicit schema and provenance columns
    (``Source.Name``, ``Fecha_Modificacion_Archivo``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(folder)
    return df.withColumns({"Source.Name": F.col("_metadata.file_name"),
                           "Fecha_Modificacion_Archivo": F.col("_metadata.file_modification_time")})


def run_available_now(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process every file not seen by ``checkpoint`` and stop (batch-like run)."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def replace_dates(path: str, date_col: str) -> Callable[[DataFrame, int], None]:
    """STR-01: the batch's dates replace those of the table (MRG-01), partition by partition."""
    return lambda batch, _id: replace_keys(batch.sparkSession, path, batch, date_col)


def add_distinct(path: str, ignore_cols: tuple[str, ...] = ()) -> Callable[[DataFrame, int], None]:
    """STR-01 without a date column: new rows only (MRG-02)."""
    return lambda batch, _id: append_new_rows(batch.sparkSession, path, batch, ignore_cols)


def _reversed(df: DataFrame, name: str) -> Column:
    """A number that grows as the column (a number, date or timestamp) shrinks."""
    kind = df.schema[name].dataType.simpleString()
    if kind == "date":
        return -F.unix_date(c(name)).cast("long")
    if kind == "timestamp":
        return -F.unix_micros(c(name))
    if kind == "timestamp_ntz":
        return -F.unix_micros(c(name).cast("timestamp"))
    if kind in ("string", "binary", "boolean") or kind.startswith(("array", "map", "struct")):
        raise ValueError(f"the newest row cannot be told by {name}: {kind}")
    return -c(name)


def newest_by_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The newest row of each key: largest ``order_cols`` (NULL smallest), ties by the whole row, ascending, NULLs first.
    One aggregate, so that on a stream Spark's state store holds one row for each key."""
    order = [x for n in order_cols for x in (c(n).isNull(), _reversed(df, n))]
    first = F.min(F.struct(F.struct(*order), F.struct(*[c(n) for n in df.columns]).alias("row")))
    return df.groupBy(*[c(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(first.alias("__first")).select("__first.row.*")


def keep_latest_stream(stream: DataFrame, keys: list[str], order_cols: list[str], path: str, checkpoint: str) -> None:
    """STR-02: process the new files; the keys that changed are written as one partition for each batch, which a replay
    overwrites. The state store's provider is the session's (RocksDB where keys outgrow memory)."""
    def write(changed: DataFrame, batch_id: int) -> None:
        rows = changed.withColumn(BATCH, F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)

    run_available_now(newest_by_key(stream, keys, order_cols), write, checkpoint, mode="update")


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row of each key: the one that the last batch wrote which changed it. One aggregate."""
    df = spark.read.parquet(path)
    rows = [n for n in df.columns if n != BATCH]
    last = F.max_by(F.struct(*[c(n) for n in rows]), BATCH).alias("row")
    return df.groupBy(*[c(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(last).select("row.*")
