"""Labelled training rows, and folds by document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import named


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL ids are in none."""
    return F.crc32(id_col.cast("string")) % folds


def is_fold(id_col: Column, folds: int, k: int) -> Column:
    return F.coalesce(fold(id_col, folds) == k, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int | None, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 0) -> DataFrame:
    """(id, text, label) of at most ``most`` labelled documents outside the held-out fold, those whose
    ids hash lowest, or with no bound of all of them. Of several labels of an id the larger counts, of several texts the smallest.

    The chosen ids are at most ``most``, so they are broadcast to the documents' scan; without a bound both are dealt by id."""
    seen = labels.select(named(id_col).alias("id"), named(label).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    seen = seen.where(fold(F.col("id"), folds) != held_out).groupBy("id").agg(F.max("label").alias("label"))
    chosen = seen if most is None else F.broadcast(seen.orderBy(F.xxhash64("id"), "id").limit(most))
    texts = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    return texts.join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "text", "label")


def schema_of(kept: DataFrame, ddl: str) -> StructType:
    """The id column as it is, then further columns."""
    return StructType([kept.schema["id"], *StructType.fromDDL(ddl)])
