"""Surrogate keys, validity intervals and reshaping (KEY-01/02, SCD-01/02, UNP-01)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach_scalar

from ..functions.core import as_col, c
from ..session import cut_lineage
from .joins import attach_sk  # KEY-01 re-export  # noqa: F401


def global_sequence(df: DataFrame, order: list[str], out: str = "seq", start: int = 1,
                    num_partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Dense 1..N numbering in ``order`` without a single-partition window.

    Range-partition on the order keys, sort within partitions, take the
    per-partition position, count rows per partition (a tiny table: one row
    per partition), prefix-sum those counts and add the offset. The ranged,
    positioned rows are checkpointed to the shared checkpoint folder so both
    uses see the same partitioning even after an executor loss."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [c(o) for o in order]
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()))
    if checkpoint:
        ranged = cut_lineage(ranged)
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), 33)
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    offs = counts.withColumn(
        "__off", F.coalesce(F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)))
    return (ranged.join(F.broadcast(offs.select("__pid", "__off")), "__pid")
            .withColumn(out, (F.col("__off") + local + F.lit(start)).cast("long"))
            .drop("__pid", "__mid", "__off"))


def assign_sk(current: DataFrame, previous: DataFrame | None, natural_key: str, sk: str = "Cliente_SK") -> DataFrame:
    """KEY-02: stable surrogate keys. Known natural keys keep their SK; new ones
    get max(previous SK)+1.. in natural-key order (D-19). NULL/blank keys dropped."""
    cur = current.filter(c(natural_key).isNotNull() & (F.trim(c(natural_key).cast("string")) != ""))
    if previous is None:
        return global_sequence(cur, [natural_key], out=sk)
    prev = previous.select(c(natural_key).alias("__nk"), c(sk).alias("__psk")).filter(F.col("__psk").isNotNull())
    joined = cur.join(prev, c(natural_key) == F.col("__nk"), "left").drop("__nk")
    known = joined.filter(F.col("__psk").isNotNull()).withColumn(sk, F.col("__psk").cast("long")).drop("__psk")
    new = joined.filter(F.col("__psk").isNull()).drop("__psk")
    max_sk = previous.agg(F.coalesce(F.max(c(sk)), F.lit(0)).cast("long").alias("__max"))
    numbered = global_sequence(new, [natural_key], out="__seq")
    numbered = (attach_scalar(numbered, max_sk)
                .withColumn(sk, F.col("__max") + F.col("__seq")).drop("__max", "__seq"))
    return known.unionByName(numbered)


def validity_intervals(df: DataFrame, identity: list[str], start_col: str, start_out: str = "Fecha_Inicio",
                       end_out: str = "Fecha_Fin", state_out: str = "Estado_Vigencia",
                       active: str = "ACTIVO", historic: str = "HISTÓRICO", tie_break: list[str] = (),
                       bucket_unit: str | None = "month") -> DataFrame:
    """SCD-01: each snapshot row is valid until the identity's next snapshot
    start (bucketed lead, skew-safe for a hot identity)."""
    from .windows import next_value, time_bucket

    bucket = time_bucket(df, start_col, bucket_unit)
    return (next_value(df, identity, [c(start_col)] + [c(t) for t in tie_break], start_col, end_out, bucket=bucket)
            .withColumn(start_out, c(start_col))
            .withColumn(state_out, F.when(F.col(end_out).isNull(), F.lit(active)).otherwise(F.lit(historic))))


def scd2(df: DataFrame, identity: list[str], start_col: str, tracked: list[str],
         start_out: str = "valid_from", end_out: str = "valid_to", current_out: str = "is_current",
         tie_break: list[str] = (), bucket_unit: str | None = "month") -> DataFrame:
    """SCD-02: true type-2 history. Consecutive snapshots with unchanged tracked
    attributes collapse into one version; a change opens a new version and
    closes the previous one at the change time. Previous/next values use the
    bucketed (skew-safe) lead, so a hot identity is not sorted by one task."""
    from .windows import next_value, time_bucket

    order = [start_col, *tie_break]
    bucket = time_bucket(df, start_col, bucket_unit)
    h = F.xxhash64(*[F.coalesce(c(t).cast("string"), F.lit("\u0000")) for t in tracked])
    marked = next_value(df.withColumn("__h", h), identity, order, "__h", "__prev", bucket=bucket, reverse=True)
    firsts = marked.filter(F.col("__prev").isNull() | (F.col("__prev") != F.col("__h"))).drop("__h", "__prev")
    out = next_value(firsts, identity, [c(o) for o in order], start_col, end_out, bucket=bucket)
    return (out.withColumn(start_out, c(start_col)).withColumn(current_out, F.col(end_out).isNull()))


def unpivot_months(df: DataFrame, id_cols: list[str], month_cols: list[str], year: int | Column,
                   status_col: str = "ESTATUS", statuses: tuple[str, ...] = ("ACTIVO", "ANULADO", "CORTADO"),
                   value_out: str = "Cantidad", month_out: str = "Mes_Nombre") -> DataFrame:
    """UNP-01: month columns -> rows; NULL, non-integer and <= 0 cells dropped;
    year and first-of-month date added; status whitelist applied."""
    from ..functions.dates import first_of_month, month_number_es

    long = df.unpivot(id_cols, month_cols, month_out, "__raw")
    v = F.trim(F.col("__raw").cast("string")).try_cast("double")
    yr = year if isinstance(year, Column) else F.lit(year)
    return (long.withColumn(value_out, v.cast("long"))
            .filter(v.isNotNull() & (v > 0) & (v == F.floor(v)))
            .filter(F.upper(F.trim(c(status_col))).isin(*statuses))
            .withColumn("Anio", yr.cast("int"))
            .withColumn("Fecha", first_of_month(F.col("Anio"), month_number_es(F.col(month_out))))
            .drop("__raw"))
