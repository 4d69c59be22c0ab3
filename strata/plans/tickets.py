"""Service tickets: SLA and failure index (PL-15, KPI-01..05).

Input: bronze ticket rows (all text or typed) with the report's column names
plus ``Source.Name`` (the file name carrying the period ``d-m-Y al d-m-Y``).
The per-file loop of a desktop job becomes columns: the period bounds are
parsed from ``Source.Name`` per row, so one scan handles every file."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import garbage_to_null, normalize_id
from ..functions.core import c
from ..functions.dates import indicator, minutes_between, parse_mixed, with_period
from ..operators.filters import period_with_backlog
from ..operators.rules import Rule, classify
from ..operators.windows import keep_first

SLA_HOURS = 24.0  # fixed value: SLA target in hours

OPENED, PRINTED, CLOSED = "Fecha Apertura", "Fecha Impresion", "Fecha Cierre"
RES, DISP, PRINT = "SLA Resolucion Min", "SLA Despacho Min", "SLA Impresion Min"


# The columns of the silver table, in its order; those that no extract brings are left out.
SILVER_COLUMNS = ["Quincena Evaluada", "FechaInicio", "FechaFin", OPENED, PRINTED, CLOSED, "Fecha Apertura Date",
                  "Fecha Cierre Date", "Es_Falla", "Cumplio_SLA", "Duracion_Horas", RES, DISP, PRINT, "Franquicia",
                  "Grupo Trabajo", "Grupo Afinidad", "Clasificacion", "N° Contrato", "N° Orden", "Estatus contrato",
                  "Estatus_orden", "Usuario Final", "Usuario Emisión", "Usuario Impresión", "Solucion Aplicada",
                  "Detalle Orden", "SLA Detalle Texto"]


@dataclass
class TicketRules:
    """Parameters of the ticket job (all synthetic/user supplied)."""

    classification: list[Rule]
    exclude_solutions: list[str] = field(default_factory=list)
    exclude_group_contains: list[str] = field(default_factory=list)
    exclude_detail_equals: list[str] = field(default_factory=list)
    exclude_status_contains: list[str] = field(default_factory=lambda: ["CREACIÓN"])
    exclude_status_in: list[str] = field(default_factory=lambda: ["ANULADA", "CANCELADA", "ELIMINADA"])


def ticket_kpis(df: DataFrame, opened: str = OPENED, closed: str = CLOSED, printed: str = PRINTED) -> DataFrame:
    """KPI-01/02: resolution/dispatch/print minutes, rounded, floored at 0, with the
    closed-ticket corrections (NULL -> 0, never printed -> dispatch 0, dispatch
    capped by resolution, print = resolution - dispatch). Open tickets untouched;
    the resolution column itself is never overwritten."""
    # Staged so each timestamp difference is computed once per row (the
    # optimizer keeps non-trivial expressions that are reused in separate projections).
    df = df.withColumns({RES: minutes_between(c(closed), c(opened)),
                         "__des": minutes_between(c(closed), c(printed)),
                         "__imp": minutes_between(c(printed), c(opened))})
    is_closed = c(closed).isNotNull()
    remote = is_closed & c(printed).isNull()
    df = df.withColumns({
        "__res_c": F.when(is_closed, F.coalesce(c(RES), F.lit(0.0))).otherwise(c(RES)),
        "__des_c": F.when(remote, F.lit(0.0)).when(is_closed, F.coalesce(F.col("__des"), F.lit(0.0)))
                    .otherwise(F.col("__des"))})
    df = df.withColumn(DISP, F.when(is_closed, F.least(F.col("__des_c"), F.col("__res_c"))).otherwise(F.col("__des")))
    df = df.withColumn(PRINT, F.when(is_closed, F.col("__res_c") - c(DISP)).otherwise(F.col("__imp")))
    return df.drop("__des", "__imp", "__res_c", "__des_c")


def ticket_flags(df: DataFrame, class_col: str = "Clasificacion") -> DataFrame:
    """KPI-03: hours, fault flag (0 only for ADMINISTRATIVO, so N/S is a fault),
    SLA compliance 0 < hours <= 24."""
    hours = c(RES) / 60.0
    return df.withColumns({
        "Duracion_Horas": hours,
        "Es_Falla": F.when(c(class_col) == "ADMINISTRATIVO", F.lit(0)).otherwise(F.lit(1)),
        "Cumplio_SLA": indicator((hours > 0) & (hours <= SLA_HOURS)),
        "Fecha Apertura Date": F.to_date(c(OPENED)),
        "Fecha Cierre Date": F.to_date(c(CLOSED)),
    })


def dedupe_tickets(df: DataFrame, period: str = "Quincena Evaluada", ticket: str = "N° Orden",
                   tie_break: list | None = None) -> DataFrame:
    """WIN-05: per (period, ticket) keep the closed row with the latest close
    (rows sorted NULL-first then the last kept). A ticket may live in two periods."""
    return keep_first(df, [period, ticket], [c(CLOSED).desc_nulls_last()], tie_break or [])


def build_silver(bronze: DataFrame, rules: TicketRules, tie_break: list | None = None) -> DataFrame:
    """PL-15 silver: period from file name (SC-20b), mixed dates (SC-04),
    backlog window (FLT-06), exclusions (FLT-02/03), classification (CLS-01),
    KPIs, id normalisation (SC-02), dedupe (WIN-05), garbage -> NULL (SC-01)."""
    # The period comes from the file name: parse each distinct name once (a few
    # hundred files) instead of running regexes per row. A name without a period has
    # NULL bounds and falls to the window below; a filter on it here would be pushed
    # under the distinct, to every row.
    names = bronze.select(c("Source.Name").alias("__src")).distinct()
    periods = with_period(names, "__src", "__p_", loose=True)
    periods = periods.select("__src", F.col("__p_start").alias("FechaInicio"), F.col("__p_end").alias("FechaFin"),
                             F.col("__p_label").alias("Quincena Evaluada"))
    # Dates are parsed before the join: a filter on them above a projection repeats the
    # parsing for each use of a date.
    df = bronze.withColumns({src: parse_mixed(c(src)) for src in ["Fecha Creacion", "Fecha Impresion", "Fecha Finalizacion"]
                             if src in bronze.columns})
    # One row per file: sent to the rows, since the files' names would deal these into a few tasks.
    df = df.join(F.broadcast(periods), c("Source.Name") == F.col("__src")).drop("__src")
    # D-11: the close window starts on the start day inside the end month, clamped to month end.
    end = F.col("FechaFin")
    start_day = F.dayofmonth(F.col("FechaInicio"))
    close_lo = F.least(F.date_add(F.trunc(end, "month"), start_day - 1), F.last_day(end)).cast("timestamp_ntz")
    df = df.filter(period_with_backlog(c("Fecha Creacion"), c("Fecha Finalizacion"), F.col("FechaInicio"), end, close_lo))
    up = lambda n: F.upper(F.coalesce(c(n).cast("string"), F.lit("")))
    excl = F.lit(False)
    if rules.exclude_solutions:
        excl = excl | up("Solucion Aplicada").isin(*[s.upper() for s in rules.exclude_solutions])
    for g in rules.exclude_group_contains:
        excl = excl | up("Grupo Trabajo").contains(g.upper())
    if rules.exclude_detail_equals:
        excl = excl | up("Detalle Orden").isin(*[s.upper() for s in rules.exclude_detail_equals])
    for s in rules.exclude_status_contains:
        excl = excl | up("Estatus_orden").contains(s.upper())
    if rules.exclude_status_in:
        excl = excl | up("Estatus_orden").isin(*rules.exclude_status_in)
    df = df.filter(~excl)
    df = df.withColumnsRenamed({"Fecha Creacion": OPENED, "Fecha Finalizacion": CLOSED})
    df = df.withColumn("Clasificacion", classify(rules.classification, "N/S"))
    df = ticket_flags(ticket_kpis(df), "Clasificacion")
    for idc in ["N° Orden", "N° Contrato"]:
        if idc in df.columns:
            df = df.withColumn(idc, normalize_id(c(idc), strip_dots=False))
    kept = [n for n in SILVER_COLUMNS if n in df.columns]
    df = dedupe_tickets(df, tie_break=tie_break or [c(n).asc_nulls_first() for n in kept]).select(*[c(n) for n in kept])
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({n: garbage_to_null(c(n)) for n in strings})


def sla_gold(silver: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """KPI-04 / AGG-01: resolved tickets only (resolution not NULL and > 0);
    NULL-key groups dropped (pandas groupby); distinct tickets + minute sums."""
    keys = keys or ["Quincena Evaluada", "Franquicia", "Clasificacion", "Fecha Apertura Date"]
    df = silver.filter(c(RES).isNotNull() & (c(RES) > 0))
    for k in keys:
        df = df.filter(c(k).isNotNull())
    return df.groupBy(*[c(k) for k in keys]).agg(
        F.count_distinct(c("N° Orden")).alias("Total_Ordenes"),
        F.sum(c(RES)).alias(RES), F.sum(c(DISP)).alias(DISP), F.sum(c(PRINT)).alias(PRINT))


def idf_gold(silver: DataFrame, only_faults: bool = False) -> DataFrame:
    """AGG-02: distinct tickets per period x franchise x open/close date, NULL
    keys kept (``dropna=False``). D-14: all tickets unless ``only_faults``."""
    df = silver.filter(c("Es_Falla") == 1) if only_faults else silver
    return df.groupBy("Quincena Evaluada", "Franquicia", "Fecha Apertura Date", "Fecha Cierre Date").agg(
        F.count_distinct(c("N° Orden")).alias("Total_Fallas"))


def idf_detail_gold(silver: DataFrame) -> DataFrame:
    """AGG-03: faults only; missing solution/detail labelled, then non-null count."""
    df = (silver.filter(c("Es_Falla") == 1)
          .withColumn("Solucion Aplicada", F.coalesce(c("Solucion Aplicada"), F.lit("EN PROCESO / SIN SOLUCIÓN")))
          .withColumn("Detalle Orden", F.coalesce(c("Detalle Orden"), F.lit("SIN DETALLE REPORTADO"))))
    return df.groupBy("Quincena Evaluada", "Franquicia", "Solucion Aplicada", "Detalle Orden").agg(
        F.count(c("N° Orden")).alias("Total_Ordenes"))


def sla_stats_gold(silver: DataFrame) -> DataFrame:
    """KPI-04: row-level SLA table, resolution not NULL (zeros kept)."""
    return silver.filter(c(RES).isNotNull()).select(
        "Quincena Evaluada", "Franquicia", "Clasificacion", RES, DISP, PRINT)


# The columns of the fact table, in its order.
FACT_COLUMNS = ["Quincena Evaluada", "Franquicia", "Fecha Apertura Date", "Fecha Cierre Date", "N° Orden", "N° Contrato",
                "Solucion Aplicada", "Detalle Orden", "Clasificacion", "Grupo Afinidad", RES, DISP, PRINT, "Cumplio_SLA",
                "Duracion_Horas", "Es_Falla"]


def fact_gold(silver: DataFrame) -> DataFrame:
    """Fact table: business columns only, open solution labelled."""
    from ..operators.shape import conform
    return conform(silver, FACT_COLUMNS).withColumn(
        "Solucion Aplicada", F.coalesce(c("Solucion Aplicada"), F.lit("EN PROCESO / SIN SOLUCIÓN")))


def failure_index(idf: DataFrame, stock: DataFrame) -> DataFrame:
    """KPI-05: faults / subscriber stock per period x franchise (stock from the
    subscriber job's gold: Quincena Evaluada, Franquicia, Total_Abonados)."""
    f = idf.groupBy("Quincena Evaluada", "Franquicia").agg(F.sum("Total_Fallas").alias("Total_Fallas"))
    return (f.join(stock.select("Quincena Evaluada", "Franquicia", "Total_Abonados"),
                   ["Quincena Evaluada", "Franquicia"], "left")
            .withColumn("IDF", F.try_divide(F.col("Total_Fallas").cast("double"), F.col("Total_Abonados"))))


def build(bronze: DataFrame, rules: TicketRules) -> dict[str, DataFrame]:
    silver = build_silver(bronze, rules)
    return {"Tickets_Silver_Master": silver, "SLA_Gold": sla_gold(silver), "IDF_Gold": idf_gold(silver),
            "IDF_Gold_Detalle_Solucion": idf_detail_gold(silver), "SLA_GOLD_STATS": sla_stats_gold(silver),
            "Tickets_Fact_Gold": fact_gold(silver)}
