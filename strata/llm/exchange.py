"""Packed exchange between documents and hash buckets.

Documents are dealt by a hash into *homes* of about ``HOME_BYTES`` of text. Each home hashes its
texts in numpy and sends, for each *bucket* of hash values, one packed row that holds every
distinct hash of the home once; so a window, line or passage that a third of all documents hold
reaches its bucket once from each home, not once from each document. The bucket answers with one
packed row for each home, and the home, which still has its texts, applies the answer. All three
steps are Spark shuffles on a uniform hash key; the numbers of homes and buckets follow the bytes
of the input, so that groups keep their size at any input size.
"""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import checkpoint_root

#: Text of one home, and window hashes of one bucket (about as many bytes of text as they stand for).
HOME_BYTES = 8 << 20

#: Bytes of a written table of a few numbers a row that is broadcast.
SENT_BYTES = 32 << 20

#: Documents without an id sort after all others.
NO_ID = np.iinfo(np.int64).max


def give_back() -> None:
    """Hands memory that this process has freed back to the system. A Python worker lives on after its task, beside
    those of other stages, and would keep what its largest task took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; other C libraries give back by themselves
    if trim:
        trim(0)


def batch_by_batch(fn: Callable) -> Callable:
    """fn for mapInArrow; what its task took is given back at its end."""

    def run(batches):
        yield from fn(batches)
        give_back()

    return run


def whole_group(fn: Callable) -> Callable:
    """fn for applyInArrow; what the group took beside its result is given back."""

    def run(table):
        out = fn(table)
        give_back()
        return out

    return run


def named(column: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col(f"`{column.replace('`', '``')}`")


def extra(carry: list[str]) -> Column:
    """The carried columns in one struct, by place, so that no name clashes."""
    return F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(carry)], F.lit(0).alias("c")).alias("extra")


def uncarried(df: DataFrame, carry: list[str]) -> list[Column]:
    """The carried columns under their own names again."""
    return [df["extra"][f"c{i}"].alias(c) for i, c in enumerate(carry)]


def with_extra(df: DataFrame, ddl: str) -> StructType:
    schema = StructType.fromDDL(ddl)
    return schema.add(df.schema["extra"]) if "extra" in df.columns else schema


def written(df: DataFrame) -> DataFrame:
    """The rows from a table in the shared folder, broadcast in joins if its files hold ``SENT_BYTES`` at most; a larger
    table is joined by a shuffle."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/exchange/{uuid.uuid4().hex}"
    df.write.parquet(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    rows = spark.read.schema(df.schema).parquet(path)
    return F.broadcast(rows) if size <= SENT_BYTES else rows


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of all texts: one aggregate over the text column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(named(text))), F.lit(0))).first()[0]


def n_homes(total_bytes: int, home_bytes: int = HOME_BYTES) -> int:
    return max(1, math.ceil(total_bytes / home_bytes))


def at_home(docs: DataFrame, id_col: str, text_col: str, homes: int, carry: list[str] | None = None) -> DataFrame:
    """(home, id, text[, extra]): the home follows from id and text, so NULL or repeated ids spread too."""
    k, t = named(id_col).cast("long"), named(text_col)
    cols = [F.pmod(F.xxhash64(k, t), F.lit(homes)).cast("int").alias("home"), k.alias("id"), t.alias("text")]
    if carry is not None:
        cols.append(extra(carry))
    return docs.select(*cols)


def ids_of(table: pa.Table) -> np.ndarray:
    return np.asarray(table["id"].combine_chunks().fill_null(NO_ID)) if len(table) else np.zeros(0, np.int64)


def in_order(table: pa.Table) -> pa.Table:
    """A home's rows in an order that does not depend on how the shuffle delivered them."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def pack(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), codec="zstd", asbytes=True)


def pack_small(values: np.ndarray) -> tuple[bytes, int]:
    """Integers as their differences, byte planes apart, compressed."""
    d = np.diff(values.astype(np.int64), prepend=0)
    d = ((d << 1) ^ (d >> 63)).astype("<u8")
    raw = d.view(np.uint8).reshape(-1, 8).T.copy().tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True), len(values)


def unpack_small(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    raw = pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True)
    d = np.frombuffer(raw, np.uint8).reshape(8, n).T.copy().view("<u8").reshape(-1)
    d = (d >> np.uint64(1)).astype(np.int64) ^ -(d & np.uint64(1)).astype(np.int64)
    return np.cumsum(d)


def bucket_slices(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) for a sorted bucket column."""
    if not len(bucket):
        return []
    cut = np.flatnonzero(np.diff(bucket)) + 1
    a = np.concatenate([[0], cut])
    return list(zip(bucket[a].tolist(), a.tolist(), [*cut.tolist(), len(bucket)], strict=True))


def by_home(docs: DataFrame, answers: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """fn(documents of a home, answers to it) for each home."""

    def run(own, sent):
        out = fn(own, sent)
        give_back()
        return out

    return docs.groupBy("home").cogroup(answers.groupBy("home")).applyInArrow(run, schema)
