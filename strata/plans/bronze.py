"""Bronze ingestion: report folder -> all-text table merged into history
(PL-20 and the first step of every report job; MRG-01/02/03/04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.core import c, find_column
from ..functions.dates import DEFAULT_DATE_FORMATS, parse_date
from ..sources.lake import Lake
from ..sources.partitioned import append_new_rows, replace_keys
from ..sources.workbook import read_workbooks


def prepare_batch(rows: DataFrame, date_col: str | None, formats: list[str] | None = None) -> DataFrame:
    """All-text batch; the merge column (when present) parsed to DATE with the
    first matching format (SC-03)."""
    if date_col:
        found = find_column(rows, date_col)
        if found:
            rows = rows.withColumn(found, parse_date(c(found), formats or DEFAULT_DATE_FORMATS))
    return rows


def merge_batch(spark: SparkSession, path: str, batch: DataFrame, date_col: str | None,
                ignore_cols: tuple[str, ...] = ("Source.Name", "Fecha_Modificacion_Archivo")) -> int:
    """Merge a batch into a bronze table: the partitions of its dates are replaced when it has the date column
    (MRG-01), else its new rows are appended (MRG-02; a row that another file holds too is not new)."""
    found = find_column(batch, date_col) if date_col else None
    if found is not None:
        return replace_keys(spark, path, batch, found)
    return append_new_rows(spark, path, batch, ignore_cols)


def ingest(spark: SparkSession, lake: Lake, raw_path: str, name: str, date_col: str | None = None,
           formats: list[str] | None = None, expected: list[str] | None = None) -> dict:
    """Read every workbook in ``raw_path`` and merge it into the bronze table ``name``, partition by partition. Returns
    the rows written as Spark counted them on the way (DQ-02), unreadable files and missing columns (DQ-01)."""
    rows, errors = read_workbooks(spark, raw_path)
    written = merge_batch(spark, lake.path("bronze", name), prepare_batch(rows, date_col, formats), date_col)
    return {"table": name, "written": True, "rows": written,
            "unreadable_files": [r.source_name for r in errors.select("source_name").collect()],
            "missing_columns": [n for n in expected or [] if n not in rows.columns]}


def churn_risk_bronze(spark: SparkSession, lake: Lake, raw_path: str) -> dict:
    """PL-20: churn-risk extracts merged by contract date."""
    return ingest(spark, lake, raw_path, "Churn_Risk_Raw_Bronze", "Fecha Contrato")
