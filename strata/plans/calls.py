"""Call-log report jobs sharing one builder: claims (PL-04/05/06), customer
care (PL-07), ONT off (PL-08), data updates (PL-10), win-back (PL-11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import garbage_to_null, normalize_id, replace_chain
from ..functions.core import c, find_column
from ..functions.dates import hour_bucket, parse_datetime
from ..operators.filters import date_window, in_list
from ..operators.merge import newest_version
from ..operators.rules import topic
from ..operators.shape import clean_headers, conform
from ..operators.windows import count_over, frequency_rank, keep_first, row_tiebreak
from ..sources.files import read_folders

MTIME = "Fecha_Modificacion_Archivo"
CALL_KEYS = ["N° Abonado", "Fecha Llamada", "Hora Llamada"]
DAY_FIRST = ["d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def _as_day(col: str):
    return F.date_trunc("day", parse_datetime(c(col), DAY_FIRST)).cast("timestamp_ntz")


def missing_report(df: DataFrame, expected: list[str]) -> list[str]:
    """DQ-01 (driver metadata): expected columns absent from the input."""
    return [n for n in expected if find_column(df, n) is None]


def call_report(bronze: DataFrame, columns: list[str], renames: dict[str, str] | None = None,
                keys: list[str] = CALL_KEYS, date_col: str = "Fecha Llamada", hour_col: str | None = "Hora Llamada",
                before_dedupe=None) -> DataFrame:
    """Shared builder: strip headers -> rename -> conform (missing NULL) -> day
    parse -> optional pre-dedupe step -> newest file wins per key (MRG-07) ->
    hour bucket (SC-06) -> garbage to NULL (SC-01)."""
    df = clean_headers(bronze)
    if renames:
        df = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    keep_mtime = MTIME in df.columns
    df = conform(df, columns + ([MTIME] if keep_mtime else []))
    if date_col in df.columns:
        df = df.withColumn(date_col, _as_day(date_col))
    if before_dedupe is not None:
        df = before_dedupe(df)
    if keep_mtime:
        df = newest_version(df, keys, MTIME)
    else:
        df = keep_first(df, keys, row_tiebreak(df))
    if hour_col and hour_col in df.columns:
        df = df.withColumn(hour_col, hour_bucket(c(hour_col)))
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({n: garbage_to_null(c(n)) for n in strings})


GENERAL_COLUMNS = ["N° Abonado", "Estatus", "Saldo", "Fecha Llamada", "Hora Llamada", "Origen", "Tipo Respuesta",
                   "Detalle Respuesta", "Responsable", "Suscripción", "Grupo Afinidad", "Franquicia", "Ciudad"]


def claims_general(folders: dict[str, DataFrame], alerts: list[str] | None = None) -> DataFrame:
    """PL-04: claims from several sub-folders (SRC-14), call type renamed to
    ``Origen``, newest file wins per call. Expected columns missing from the
    source are appended to ``alerts`` (DQ-01) and come out as NULL."""
    u = read_folders(folders, "Fecha_Carpeta", {}) if len(folders) > 1 else next(iter(folders.values()))
    if alerts is not None:
        alerts.extend(missing_report(clean_headers(u).withColumnsRenamed({"Tipo Llamada": "Origen"}), GENERAL_COLUMNS))
    return call_report(u, GENERAL_COLUMNS, {"Tipo Llamada": "Origen"})


APP_COLUMNS = ["N° Abonado", "Documento", "Cliente", "Estatus", "Saldo", "Fecha Llamada", "Hora Llamada",
               "Detalle Respuesta", "Responsable", "Suscripción", "Grupo Afinidad", "Franquicia", "Ciudad", "OrdenCategoria"]


def app_faults(bronze: DataFrame) -> DataFrame:
    """PL-05: detail upper-cased, category size counted BEFORE the dedupe (WIN-08)."""
    df = clean_headers(bronze)
    det = find_column(df, "Detalle Respuesta")
    df = df.withColumn("Detalle Respuesta", F.upper(F.coalesce(c(det).cast("string"), F.lit("nan"))) if det
                       else F.lit("NAN"))
    df = count_over(df, ["Detalle Respuesta"], "OrdenCategoria", "Detalle Respuesta")
    return call_report(df, APP_COLUMNS)


BANK_COLUMNS = ["N° Abonado", "Cliente", "Estatus", "Saldo", "Fecha Llamada", "Hora Llamada", "Tipo Llamada",
                "Tipo Respuesta", "Detalle Respuesta", "Responsable", "Observación", "Grupo Afinidad", "Franquicia",
                "Ciudad", "TotalCuenta"]


def bank_faults(bronze: DataFrame, targets: list[str]) -> DataFrame:
    """PL-06: rows whose detail is one of ``targets`` (upper/trim), fault prefix
    removed (SC-16), count per detail (WIN-08) before the dedupe."""
    df = clean_headers(bronze)
    det = find_column(df, "Detalle Respuesta")
    norm = F.upper(F.trim(F.coalesce(c(det).cast("string"), F.lit("nan")))) if det else F.lit("NAN")
    df = df.withColumn("Detalle Respuesta", norm).filter(in_list(F.col("Detalle Respuesta"), [t.upper() for t in targets]))
    df = df.withColumn("Detalle Respuesta", F.trim(replace_chain("Detalle Respuesta", [("FALLA CON ", ""), ("FALLA ", "")])))
    df = count_over(df, ["Detalle Respuesta"], "TotalCuenta", "Detalle Respuesta")
    return call_report(df, BANK_COLUMNS)


# Output columns of the customer-care gold.
CARE_COLUMNS = ["N° Abonado", "Documento", "Cliente", "Estatus", "Fecha", "Hora", "Tipo Llamada", "Tipo Respuesta",
                "Detalle Respuesta", "Vendedor", "Suscripción", "Grupo Afinidad", "Nombre Franquicia", "Ciudad",
                "Tipo de afluencia", "Observación"]
# Names that call extracts and golds give to the same columns.
CALL_RENAMES = {"Franquicia": "Nombre Franquicia", "Fecha Llamada": "Fecha", "Responsable": "Vendedor", "Hora Llamada": "Hora"}
HOUR_KEYS = ["N° Abonado", "Fecha", "Hora"]


def _renamed(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def customer_care(bronze: DataFrame, exclude_responses: list[str] = (), traffic_type: str = "ATENCIÓN AL CLIENTE") -> DataFrame:
    """PL-07: columns renamed to the traffic contract, ids normalised (SC-02), seller upper-cased,
    excluded responses dropped (FLT-02; NULLs stay), newest file per (subscriber, date, hour) (WIN-03),
    then the rank of the response type by frequency AFTER the dedupe (WIN-09), hour bucket."""
    df = _renamed(clean_headers(bronze), CALL_RENAMES)
    for idc in ["N° Abonado", "Documento"]:
        if idc in df.columns:
            df = df.withColumn(idc, normalize_id(c(idc), strip_dots=True))
    if "Vendedor" in df.columns:
        df = df.withColumn("Vendedor", F.upper(c("Vendedor")))
    if exclude_responses and "Tipo Respuesta" in df.columns:
        df = df.filter(in_list(c("Tipo Respuesta"), list(exclude_responses), negate=True, keep_null=True))
    df = df.withColumn("Tipo de afluencia", F.lit(traffic_type))
    out = call_report(df, CARE_COLUMNS, keys=HOUR_KEYS, date_col="Fecha", hour_col="Hora")
    return frequency_rank(out, "Tipo Respuesta", "RankingMotivo")


# Output columns of the ONT gold.
ONT_COLUMNS = ["N° Abonado", "Documento", "Cliente", "Estatus", "Fecha", "Hora", "Tipo Llamada", "Tipo Respuesta",
               "Detalle Respuesta", "Vendedor", "Suscripción", "Grupo Afinidad", "Nombre Franquicia", "Ciudad"]


def ont_off(report: DataFrame, care_gold: DataFrame, response: str) -> DataFrame:
    """PL-08: the ONT report, renamed to the care contract (PRJ-02), plus the care gold's rows with that
    response type; one row per (subscriber, date, hour), the care gold's before the report's (WIN-06)."""
    a = conform(_renamed(clean_headers(report), CALL_RENAMES), ONT_COLUMNS).withColumn("Fecha", _as_day("Fecha"))
    b = conform(care_gold.filter(c("Tipo Respuesta") == response), ONT_COLUMNS)
    u = a.withColumn("__care", F.lit(0)).unionByName(b.withColumn("__care", F.lit(1)))
    return keep_first(u, HOUR_KEYS, [c("__care").desc()] + row_tiebreak(u, exclude=("__care",))).drop("__care")


def ont_off_profile(gold: DataFrame) -> DataFrame:
    """PL-08 summary (AGG-16): count, distinct, mean, std, quartiles per column."""
    from ..operators.aggregates import profile
    return profile(gold, [n for n in gold.columns], exact_distinct=False)


# Output columns of the data-update gold, and what details are called in it.
UPDATE_COLUMNS = ["Origen", "N° Abonado", "Estatus", "Fecha", "Hora", "Detalle Respuesta", "Tipo Respuesta", "Responsable",
                  "Suscripción", "Grupo Afinidad", "Nombre Franquicia", "Ciudad"]
UPDATE_REPLACEMENTS = [("EMAIL", "CORREO ELECTRÓNICO"), ("CÉDULA DE IDENTIDAD", "CEDULA"), ("CELULAR", "TELEFONO"),
                       ("NÚMERO TELEFÓNICO", "TELEFONO")]


def data_updates(calls: DataFrame, observations: DataFrame, replacements: list[tuple[str, str]] = UPDATE_REPLACEMENTS) -> DataFrame:
    """PL-10: two feeds. Call rows keep their detail. Observation rows take the first of detail,
    observation and subject, and that free text is classified into a topic (CLS-02, SC-19). Both are
    upper-cased, cut at ``ANT:`` (SC-17) and renamed (SC-16); ``Origen`` = upper file name (SC-28);
    newest file per (subscriber, date, hour); hour bucket."""
    call_names = {"Fecha Llamada": "Fecha", "Hora Llamada": "Hora", "Franquicia": "Nombre Franquicia"}
    a = _renamed(clean_headers(calls), call_names)
    b = _renamed(clean_headers(observations), {"Franquicia": "Nombre Franquicia"})
    texts = [c(n).cast("string") for n in ["Detalle Respuesta", "Observacion", "Asunto"] if n in b.columns]
    b = b.withColumn("Detalle Respuesta", topic(F.coalesce(*texts, F.lit("")))).drop("Observacion", "Asunto")
    if "Tipo Respuesta" not in b.columns:
        b = b.withColumn("Tipo Respuesta", F.lit("GESTION INTERNA / OBS"))
    parts = [d.withColumn("Origen", F.upper(c("Source.Name")) if "Source.Name" in d.columns else F.lit("")) for d in (a, b)]
    u = parts[0].unionByName(parts[1], allowMissingColumns=True)
    detail = F.trim(F.upper(F.coalesce(c("Detalle Respuesta").cast("string"), F.lit(""))))
    u = u.withColumn("Detalle Respuesta", replace_chain(F.trim(F.substring_index(detail, "ANT: ", 1)), replacements))
    u = u.withColumn("Tipo Respuesta", F.upper(F.coalesce(c("Tipo Respuesta").cast("string"), F.lit("SIN CLASIFICAR"))))
    return call_report(u, UPDATE_COLUMNS, keys=HOUR_KEYS, date_col="Fecha", hour_col="Hora")


# Output columns of the win-back gold.
WINBACK_COLUMNS = ["Source.Name", "N° Abonado", "Documento", "Cliente", "Estatus", "Fecha", "Hora", "Tipo Respuesta",
                   "Detalle Respuesta", "Responsable", "Suscripción", "Grupo Afinidad", "Nombre Franquicia", "Ciudad",
                   "Tipo de afluencia"]
WINBACK_TEXTS = ["Cliente", "Tipo Respuesta", "Detalle Respuesta", "Responsable", "Ciudad", "Nombre Franquicia", "Grupo Afinidad"]


def win_back(bronze: DataFrame, as_of: _dt.date, traffic_type: str = "COME BACK HOME") -> DataFrame:
    """PL-11: future-dated rows rejected (FLT-05, as_of + 1 day; undated rows stay), ids and texts
    normalised, newest file's row per (subscriber, date, hour) (WIN-04), hour bucket."""
    df = _renamed(clean_headers(bronze), {k: v for k, v in CALL_RENAMES.items() if k != "Responsable"})
    df = df.withColumn("Fecha", _as_day("Fecha")).filter(date_window("Fecha", as_of=as_of, keep_undated=True))
    if "N° Abonado" in df.columns:
        df = df.withColumn("N° Abonado", normalize_id(c("N° Abonado"), strip_dots=False))
    df = df.withColumns({n: F.upper(F.trim(c(n).cast("string"))) for n in WINBACK_TEXTS if n in df.columns})
    df = df.withColumn("Tipo de afluencia", F.lit(traffic_type))
    df = conform(df, WINBACK_COLUMNS + ([MTIME] if MTIME in df.columns else []))
    newest = [c(MTIME).desc_nulls_last()] if MTIME in df.columns else []
    df = keep_first(df, HOUR_KEYS, newest + row_tiebreak(df)).drop(MTIME)
    df = df.withColumn("Hora", hour_bucket(c("Hora")))
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({n: garbage_to_null(c(n)) for n in strings})
