"""Employee master with validity intervals (PL-12) and the customer dimension
with stable surrogate keys (PL-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import garbage_to_null, normalize_id
from ..functions.core import c
from ..functions.dates import date_token
from ..operators.filters import matches
from ..operators.keys import assign_sk, validity_intervals
from ..operators.shape import clean_headers
from ..operators.windows import keep_first, keep_latest, row_tiebreak

# Headers of the employee extracts (title case) and what they hold.
EMPLOYEE_RENAMES = {"Nombre": "Nombre_Completo", "Apellido": "OficinaSae", "Oficina": "OficinaSistema",
                    "Doc. De Identidad": "Doc_Identidad", "Cedula": "Doc_Identidad", "Cédula": "Doc_Identidad"}
EMPLOYEE_COLUMNS = ["Doc_Identidad", "Nombre_Completo", "Combinado", "OficinaSae", "OficinaSistema", "Fecha_Inicio",
                    "Fecha_Fin", "Estado_Vigencia", "Franquicia Vendedor", "Franquicia Cobrador"]


def employee_master(snapshots: DataFrame, exclude_regex: str | None = None) -> DataFrame:
    """PL-12: snapshot files but consolidated ones, dated by the date token in their file name (SC-20d); texts trimmed and
    upper-cased; non-human names out (FLT-03); identity = name + the sales system's office (SC-27); one row
    per (document, identity, start), the newest file's; each is valid until the identity's next start
    (SCD-01). D-17: the identity includes the office, so a move leaves the old row active - ``scd2`` keyed
    by document fixes it."""
    if "Source.Name" in snapshots.columns:  # consolidated files repeat what the others hold
        snapshots = snapshots.filter(~F.coalesce(F.contains(F.lower(c("Source.Name")), F.lit("consolidado")), F.lit(False)))
    df = clean_headers(snapshots, "title")
    for old, new in EMPLOYEE_RENAMES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    texts = ["Doc_Identidad", "Nombre_Completo", "OficinaSae", "OficinaSistema"]
    df = df.withColumns({n: F.upper(F.trim(F.coalesce(c(n).cast("string"), F.lit("")))) if n in df.columns else F.lit("") for n in texts})
    df = df.withColumn("Fecha_Inicio", date_token(c("Source.Name")))
    if exclude_regex:
        df = df.filter(matches("Nombre_Completo", exclude_regex, negate=True))
    df = df.withColumn("Combinado", F.trim(F.concat_ws(" ", "Nombre_Completo", "OficinaSae")))
    newest = ["Fecha_Modificacion_Archivo"] if "Fecha_Modificacion_Archivo" in df.columns else []
    keys = ["Doc_Identidad", "Combinado", "Fecha_Inicio"]
    df = keep_latest(df, keys, newest, tie_break=row_tiebreak(df)) if newest else keep_first(df, keys, row_tiebreak(df))
    df = validity_intervals(df, ["Combinado"], "Fecha_Inicio", "Fecha_Inicio", "Fecha_Fin", "Estado_Vigencia")
    df = df.select(*[c(n) for n in EMPLOYEE_COLUMNS if n in df.columns])
    return df.withColumns({f.name: garbage_to_null(c(f.name)) for f in df.schema.fields if f.dataType.simpleString() == "string"})


def customer_dimension(current: DataFrame, previous: DataFrame | None, key: str = "N° Abonado",
                       sk: str = "Cliente_SK") -> DataFrame:
    """PL-13: a trailing ``.0`` of the id goes, its other dots stay (SC-02); one row per
    subscriber, the latest by (file mtime, contract date) (WIN-02); stable surrogate keys:
    known subscribers keep theirs, new ones continue after the max in key order (KEY-02)."""
    df = current.withColumn(key, normalize_id(c(key), strip_dots=False))
    order = [x for x in ["Fecha_Modificacion_Archivo", "Fecha Contrato"] if x in df.columns]
    df = keep_latest(df, [key], order, tie_break=row_tiebreak(df)) if order else keep_first(df, [key], row_tiebreak(df))
    df = df.drop("Fecha_Modificacion_Archivo", "Source.Name")
    return assign_sk(df, previous, key, sk)
