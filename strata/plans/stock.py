"""Subscriber stock per period and franchise (PL-14, MRG-05/06, SC-20c) and the
franchise dimension (PL-16) and yearly statistics (PL-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import c, first_present
from ..functions.dates import snapshot_cut
from ..operators.filters import equals_normalized
from ..operators.merge import upsert_by_label
from ..operators.shape import rename_synonyms
from ..operators.sets import value_set
from ..operators.windows import keep_latest, row_tiebreak

ID_SYNONYMS = {"ID": ["Id", "id", "ID_CLIENTE"], "Estatus": ["Estatus contrato"], "Franquicia": ["Nombre Franquicia"]}


def stock_silver(snapshot: DataFrame, active: str = "ACTIVO", test_orders: str | None = "PRUEBA DE INTERNET") -> DataFrame:
    """Snapshot rows -> (Quincena Evaluada, FechaInicio, FechaFin, ID, Estatus,
    Franquicia): synonyms unified, cut date/label from the file name (SC-20c), the
    franchise trimmed and upper-cased (NULL: ``NO DEFINIDA``), rows of test orders out,
    only active subscribers (FLT-07)."""
    df = rename_synonyms(snapshot, ID_SYNONYMS)
    cut = snapshot_cut(c("Source.Name"))
    df = df.withColumn("__cut", cut).filter(F.col("__cut.label").isNotNull())
    detail = first_present(df, ["Detalle Orden", "Detalle"])
    if detail and test_orders:
        df = df.filter(~c(detail).eqNullSafe(F.lit(test_orders)))
    df = df.filter(equals_normalized(c("Estatus"), active))
    df = df.withColumn("Franquicia", F.upper(F.trim(F.coalesce(c("Franquicia").cast("string"), F.lit("NO DEFINIDA")))))
    return df.select(F.col("__cut.label").alias("Quincena Evaluada"),
                     F.col("__cut.cut").cast("timestamp_ntz").alias("FechaInicio"),
                     F.col("__cut.cut").cast("timestamp_ntz").alias("FechaFin"),
                     c("ID"), c("Estatus"), c("Franquicia"))


def stock_gold(silver: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """AGG-04 / MRG-06: distinct subscribers and cut date per period x franchise.
    Gold is always a pure function of silver, so "rebuild when missing" is just
    running this. D-10: the first load drops NULL-key groups (``drop_null_keys``)."""
    df = silver.dropna(subset=["Quincena Evaluada", "Franquicia"]) if drop_null_keys else silver
    return df.groupBy("Quincena Evaluada", "Franquicia").agg(
        F.count_distinct(c("ID")).alias("Total_Abonados"), F.max(c("FechaFin")).alias("Fecha_Corte"))


def merge_stock(history: DataFrame | None, batch_silver: DataFrame, order_col: str = "FechaFin") -> DataFrame:
    """MRG-05: replace whole periods by label; batch deduped per (label, ID)."""
    if history is None:
        return keep_latest(batch_silver, ["Quincena Evaluada", "ID"], [order_col], tie_break=row_tiebreak(batch_silver))
    return upsert_by_label(history, batch_silver, "Quincena Evaluada", "ID", [order_col])


def franchise_dim(*sources: DataFrame, col: str = "Franquicia") -> DataFrame:
    """PL-16: distinct franchise names of the stock and ticket golds, blanks and
    ``NO DEFINIDA`` removed, sorted."""
    return value_set(*[(s, first_present(s, [col]) or col) for s in sources], out=col)


def yearly_statistics(files: DataFrame, wide: DataFrame, year_col: str = "Anio",
                      status_col: str = "ESTATUS") -> tuple[DataFrame, DataFrame]:
    """PL-17: from the newest statistics file per year (SRC-11, ``files`` =
    (path, Fecha, Anio)) the month columns are unpivoted (UNP-01, SC-09) and
    stacked (SET-03); returns (history rows, yearly summary AGG-06)."""
    from ..functions.dates import MONTHS_ES
    from ..operators.keys import unpivot_months

    months = [m for m in MONTHS_ES if m.upper() in [x.upper() for x in wide.columns]]
    cols = [next(x for x in wide.columns if x.upper() == m.upper()) for m in months]
    keep = wide.join(files.select(F.col("path").alias("__p")), c("Source.Name") == F.col("__p"), "left_semi") \
        if "Source.Name" in wide.columns else wide
    rows = unpivot_months(keep, [status_col, year_col], cols, F.col(year_col), status_col=status_col)
    summary = (rows.groupBy(F.col("Anio")).agg(F.count(F.lit(1)).alias("Registros"), F.sum("Cantidad").alias("Total"))
               .orderBy("Anio"))
    return rows, summary
