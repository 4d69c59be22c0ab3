"""Sales listing (PL-02) and sales status (PL-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import garbage_to_null, office_after_marker, squish
from ..functions.core import c
from ..functions.dates import hour_bucket, month_name_es, parse_date
from ..operators.filters import in_list, matches
from ..operators.merge import newest_version
from ..operators.resolve import place_override
from ..operators.rules import sales_channel
from ..operators.shape import clean_headers, conform
from ..operators.windows import keep_first, row_tiebreak

# The columns of the sales listing that are read, and those that do not reach the gold table.
LISTING_COLUMNS = ["ID", "N° Abonado", "Fecha Contrato", "Estatus", "Suscripción", "Grupo Afinidad",
                   "Nombre Franquicia", "Ciudad", "Vendedor", "Serv/Paquete", "nombre_detectado", "Estado",
                   "oficina_comercial", "tipo_coincidencia", "fuzzy_score_nombre", "fuzzy_score_apellido",
                   "fuzzy_score_combinado", "Fecha_Modificacion_Archivo"]
LISTING_DROPPED = ["Estado", "Cliente", "ID", "Serv/Paquete", "fuzzy_score_nombre", "fuzzy_score_apellido", "fuzzy_score_combinado"]


def sales_listing(bronze: DataFrame, office_sellers: list[str], own_sellers: list[str],
                  overrides: list[tuple[list[str], dict[str, str]]] = ()) -> DataFrame:
    """PL-02: conform (PRJ-05), the office under its own name, the constant kind of traffic, month name (SC-08), texts
    trimmed and in one case (NULL as empty until the end), place overrides (ER-05), channel (CLS-03), rows pending
    review dropped (FLT-02; NULL match type kept when the column is absent from the source, D-03), newest file per
    (subscriber, contract date) (MRG-07), garbage -> NULL (SC-01)."""
    had_type = "tipo_coincidencia" in bronze.columns
    df = conform(clean_headers(bronze), LISTING_COLUMNS).withColumnRenamed("oficina_comercial", "Oficina")
    df = df.withColumn("Tipo de afluencia", F.lit("VENTAS")).withColumn("Fecha Contrato", parse_date(c("Fecha Contrato")))
    df = df.withColumn("Mes", month_name_es(F.month("Fecha Contrato"), "title"))
    clean = lambda t: F.trim(F.coalesce(c(t).cast("string"), F.lit("")))
    df = df.withColumns({t: F.upper(clean(t)) for t in ["Ciudad", "nombre_detectado", "Oficina", "N° Abonado"]} | {"Vendedor": F.lower(clean("Vendedor"))})
    for markers, sets in overrides:
        df = place_override(df, "Vendedor", markers, sets)
    df = df.withColumn("Canal", sales_channel("Vendedor", "nombre_detectado", "tipo_coincidencia", office_sellers, own_sellers))
    df = df.filter(in_list(c("tipo_coincidencia"), ["Pendiente de Revisión"], negate=True, keep_null=not had_type))
    df = newest_version(df.drop(*LISTING_DROPPED), ["N° Abonado", "Fecha Contrato"])
    return df.withColumns({f.name: garbage_to_null(c(f.name)) for f in df.schema.fields if f.dataType.simpleString() == "string"})


# Names that sales extracts give to a column, and the output columns of the sales-status gold.
STATUS_RENAMES = {"Fecha Venta": "Fecha", "Franquicia": "Nombre Franquicia", "Hora venta": "Hora", "Cédula": "Documento",
                  "Rif": "Documento", "Nro. Doc": "Documento"}
STATUS_CHECKED = ["Paquete/Servicio", "Vendedor", "N° Abonado", "Cliente", "Estatus", "Documento"]
STATUS_COLUMNS = ["N° Abonado", "Documento", "Estatus", "Fecha", "Vendedor", "Costo", "Grupo Afinidad",
                  "Nombre Franquicia", "Ciudad", "Hora", "Tipo de afluencia", "Oficina"]
MTIME = "Fecha_Modificacion_Archivo"


def sales_status(bronze: DataFrame, seller_marker: str = "OFI", exclude_seller_regex: str | None = "VENTAS CALLE|AGENTE",
                 exclude_package_regex: str | None = None, alerts: list[str] | None = None) -> DataFrame:
    """PL-03: one row-level table (silver and gold alike). Columns renamed (PRJ-02), absent
    ones alerted (DQ-01); excluded packages and sellers out, office sellers only (FLT-03);
    office after the marker (SC-15); hour bucket (SC-06) before the newest file's row per
    (subscriber, date, hour) is kept (MRG-07)."""
    df = clean_headers(bronze)
    for old, new in STATUS_RENAMES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    if alerts is not None:
        expected = dict.fromkeys([*STATUS_CHECKED, *STATUS_COLUMNS])
        alerts.extend(n for n in expected if n not in df.columns and n not in ("Tipo de afluencia", "Oficina"))
    keep_mtime = MTIME in df.columns
    df = conform(df, [n for n in STATUS_COLUMNS if n != "Oficina"] + ["Paquete/Servicio"] + ([MTIME] if keep_mtime else []))
    df = df.withColumn("Vendedor", F.trim(F.upper(c("Vendedor").cast("string"))))
    if exclude_package_regex:
        df = df.filter(matches(F.upper(c("Paquete/Servicio").cast("string")), exclude_package_regex, negate=True))
    if exclude_seller_regex:
        df = df.filter(matches("Vendedor", exclude_seller_regex, negate=True))
    df = df.filter(matches("Vendedor", seller_marker)).drop("Paquete/Servicio")
    df = df.withColumn("Tipo de afluencia", F.lit("Ventas")).withColumn("Oficina", office_after_marker("Vendedor"))
    df = df.withColumn("Fecha", parse_date(c("Fecha")).cast("timestamp_ntz")).withColumn("Hora", hour_bucket(c("Hora")))
    keys = ["N° Abonado", "Fecha", "Hora"]
    df = newest_version(df, keys) if keep_mtime else keep_first(df, keys, row_tiebreak(df))
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[c(n) for n in STATUS_COLUMNS]).withColumns({n: garbage_to_null(c(n)) for n in strings if n in STATUS_COLUMNS})
