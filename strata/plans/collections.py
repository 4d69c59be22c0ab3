"""Collections (PL-01) and collection calls (PL-09)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import decimal_comma, garbage_to_null, normalize_id
from ..functions.core import c, col_or_default, first_present
from ..functions.dates import DEFAULT_DATE_FORMATS, hour_bucket, parse_date
from ..operators.filters import date_window, matches
from ..operators.joins import left_latest
from ..operators.rules import office_ownership, responsible_channel
from ..operators.windows import keep_first, keep_latest, row_tiebreak

# Payment id synonyms: the extract renamed the column over time (D-15).
PAYMENT_ID = ["ID Pago", "Nro Recibo"]
COLLECTION_FORMATS = ["yyyy-MM-dd", "d/M/yyyy H:mm:ss", "d/M/yyyy", "d-M-yyyy H:mm:ss", "d-M-yyyy",
                      "yyyy-MM-dd HH:mm:ss"]
GOLD_COLUMNS = ["ID Contrato", "N° Abonado", "Fecha", "Total Pago", "Forma de Pago", "Banco", "Oficina",
                "Fecha Contrato", "Estatus", "Suscripción", "Grupo Afinidad", "Nombre Franquicia", "Ciudad", "Vendedor",
                "Tipo de afluencia", "Clasificacion", "Hora de Pago"]


def collections_gold(payments: DataFrame, hours: DataFrame | None, own_offices: list[str],
                     exclude_office_regex: str | None = None) -> DataFrame:
    """PL-01: payments with an id (FLT-01), excluded offices dropped (FLT-03),
    payment hour from the hours extract joined on the normalised id after
    pre-aggregation (JON-01, SC-07 default 00:00), typed fields (SC-03/18/25),
    office ownership (CLS-04), latest row per payment id (WIN-01). The payment
    id itself is not in the output (D-20). Optional columns are resolved from
    the schema (SRC-04)."""
    pid = first_present(payments, PAYMENT_ID)
    if pid is None:
        raise ValueError("collections_gold(): no payment id column (ID Pago / Nro Recibo)")
    df = payments.filter(c(pid).isNotNull()).withColumn("__pid", normalize_id(c(pid), strip_dots=False))
    office = col_or_default(payments, "Oficina Cobro", "string", "")
    if exclude_office_regex:
        df = df.filter(matches(office, exclude_office_regex, negate=True))
    if hours is not None and first_present(hours, PAYMENT_ID) and first_present(hours, ["Hora de Pago"]):
        hid, hcol = first_present(hours, PAYMENT_ID), first_present(hours, ["Hora de Pago"])
        h = hours.filter(c(hid).isNotNull()).withColumn("__hk", normalize_id(c(hid), strip_dots=False))
        df = left_latest(df, h, "__pid", "__hk", {"__hora": F.max(c(hcol))})
        hour = hour_bucket(F.col("__hora"), default="00:00")
    else:
        hour = F.lit("00:00")
    s = lambda n, d="": col_or_default(payments, n, "string", d)
    out = df.select(
        col_or_default(payments, "ID Contrato", "string").alias("ID Contrato"), F.col("__pid"),
        s("N° Abonado").alias("N° Abonado"), parse_date(col_or_default(payments, "Fecha", "string"), COLLECTION_FORMATS).alias("Fecha"),
        decimal_comma(col_or_default(payments, "Total Pago", "string")).alias("Total Pago"),
        s("Forma de Pago").alias("Forma de Pago"), s("Banco").alias("Banco"), office.alias("Oficina"),
        col_or_default(payments, "Fecha Contrato", "string").alias("Fecha Contrato"), s("Estatus").alias("Estatus"),
        s("Suscripción").alias("Suscripción"), s("Grupo Afinidad").alias("Grupo Afinidad"),
        s("Nombre Franquicia").alias("Nombre Franquicia"), s("Ciudad").alias("Ciudad"), s("Cobrador").alias("Vendedor"),
        F.lit("RECAUDACIÓN").alias("Tipo de afluencia"), office_ownership(office, own_offices).alias("Clasificacion"),
        hour.alias("Hora de Pago"))
    out = keep_latest(out, ["__pid"], ["Fecha"], tie_break=row_tiebreak(out))
    return out.select(*GOLD_COLUMNS)


CALL_DATE_FORMATS = ["yyyy-MM-dd", "d/M/yyyy H:mm:ss", "d/M/yyyy", "yyyy-MM-dd HH:mm:ss", "d-M-yyyy"]


def collection_calls_gold(bronze: DataFrame, as_of: _dt.date) -> DataFrame:
    """PL-09: the extract's own columns (SRC-04) but the customer's name, in their order: ids without a trailing ``.0``
    (SC-02), dates (SC-03), the city upper-cased with a default, the call's hour as ``Hora`` with a default (SC-07),
    other texts trimmed and garbage -> NULL (SC-01); then the channel from the responsible (CLS-04). Subscriber present
    (FLT-01), not future-dated (FLT-05), newest file per (subscriber, date, hour) with a full-row tie break (WIN-01)."""
    cols = []
    for f in bronze.schema.fields:
        x, text = c(f.name), f.dataType.simpleString() == "string"
        if f.name == "Cliente":
            continue
        if f.name in ("N° Abonado", "Documento"):
            x = normalize_id(garbage_to_null(x.cast("string"), trim_values=True), strip_dots=False)
        elif f.name == "Fecha Llamada":
            x = parse_date(x, CALL_DATE_FORMATS) if text else x.cast("date")
        elif f.name == "Ciudad":
            x = F.upper(F.coalesce(F.nullif(F.trim(x.cast("string")), F.lit("")), F.lit("NO ESPECIFICADO")))
        elif f.name == "Hora Llamada":
            cols.append(hour_bucket(x.cast("string"), default="00:00").alias("Hora"))
            continue
        elif text:
            x = F.trim(garbage_to_null(x, trim_values=True))
        cols.append(x.alias(f.name))
    df = bronze.select(*cols, responsible_channel(col_or_default(bronze, "Responsable", "string")).alias("Canal"))
    df = df.filter(c("N° Abonado").isNotNull()).filter(date_window("Fecha Llamada", as_of=as_of))
    newest = [c(n).desc_nulls_last() for n in ["Fecha_Modificacion_Archivo"] if n in df.columns]
    return keep_first(df, [n for n in ["N° Abonado", "Fecha Llamada", "Hora"] if n in df.columns], newest + row_tiebreak(df))
