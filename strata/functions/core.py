"""Small shared helpers for column names and safe column access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def c(name: str) -> Column:
    """Column by literal name: names with dots, spaces, accents or symbols
    (``Source.Name``, ``N° Abonado``) are back-quoted so they never resolve as
    struct access."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_col(x) -> Column:
    return c(x) if isinstance(x, str) else x


def find_column(df: DataFrame, name: str) -> str | None:
    """Case-insensitive, whitespace-tolerant lookup of a column name (schema only)."""
    want = name.strip().lower()
    for n in df.columns:
        if n.strip().lower() == want:
            return n
    return None


def col_or_default(df: DataFrame, name: str, dtype: DataType | str = StringType(), default=None) -> Column:
    """SRC-04: the column if the schema has it (case-insensitive), else a typed
    default literal. Decided from ``df.schema`` on the driver, no data read."""
    found = find_column(df, name)
    if found is not None:
        return c(found).cast(dtype)
    return F.lit(default).cast(dtype)


def first_present(df: DataFrame, names: list[str]) -> str | None:
    for n in names:
        f = find_column(df, n)
        if f is not None:
            return f
    return None


def rows_counted(counted, name: str = "n") -> int:
    """What an ``Observation`` of a finished write counted; 0 where Spark found at run time that there is nothing to
    write and dropped the plan with its counter, in which case there are no metrics to read."""
    from py4j.protocol import Py4JJavaError

    try:
        return counted.get.get(name) or 0
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return 0
