"""Source -> job -> sink wiring for the main jobs (the ``run`` side of each
``build``): workbooks are ingested into bronze, the job's silver/gold tables
are published to the lake with safe replace, and an audit row per table is
returned."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_token, snapshot_cut
from ..sources.files import latest_file, latest_per_year, list_files, pending_snapshots, read_dimension_csv
from ..sources.lake import Lake
from ..sources.partitioned import read_table, replace_keys, table_exists
from ..sources.workbook import read_workbooks
from . import calls as CL
from . import collections as CO
from . import people as PE
from . import sales as SA
from . import stock as ST
from . import tickets as T
from . import traffic as TR
from .bronze import ingest
from .suite import Job


def _publish(lake: Lake, tables: dict[str, tuple[str, DataFrame]]) -> list[dict]:
    return [lake.save(df, layer, name, audit=True) for name, (layer, df) in tables.items()]


def run_tickets(spark: SparkSession, lake: Lake, raw_path: str, rules: T.TicketRules) -> list[dict]:
    """PL-15: every ticket workbook (the period comes from each file name) ->
    silver master + the five golds."""
    rows, errors = read_workbooks(spark, raw_path, exclude=("consolidado",))
    out = T.build(rows, rules)
    silver = out.pop("Tickets_Silver_Master")
    lake.save(silver, "silver", "Tickets_Silver_Master", audit=True)
    silver = lake.read("silver", "Tickets_Silver_Master")  # golds re-read the written silver (lineage cut)
    golds = {"SLA_Gold": T.sla_gold(silver), "IDF_Gold": T.idf_gold(silver),
             "IDF_Gold_Detalle_Solucion": T.idf_detail_gold(silver), "SLA_GOLD_STATS": T.sla_stats_gold(silver),
             "Tickets_Fact_Gold": T.fact_gold(silver)}
    return _publish(lake, {k: ("gold", v) for k, v in golds.items()}) + _unreadable(errors)


def _unreadable(errors: DataFrame) -> list[dict]:
    """One audit entry for each workbook that could not be read."""
    return [{"file": r.source_name, "written": False, "reason": r.error} for r in errors.select("source_name", "error").toLocalIterator()]


def run_collections(spark: SparkSession, lake: Lake, payments_raw: str, hours_raw: str | None,
                    own_offices: list[str], exclude_office_regex: str | None = None) -> list[dict]:
    """PL-01: both extracts merged into bronze by date, then the gold table."""
    ingest(spark, lake, payments_raw, "Recaudacion_Raw_Bronze", "Fecha")
    hours = None
    if hours_raw:
        ingest(spark, lake, hours_raw, "HorasPago_Raw_Bronze", "Fecha")
        hours = read_table(spark, lake.path("bronze", "HorasPago_Raw_Bronze"))
    gold = CO.collections_gold(read_table(spark, lake.path("bronze", "Recaudacion_Raw_Bronze")), hours, own_offices, exclude_office_regex)
    return _publish(lake, {"Recaudacion_Gold": ("gold", gold)})


def stock_tables(spark: SparkSession, lake: Lake, raw_path: str) -> tuple[DataFrame, DataFrame]:
    """PL-14: snapshot workbooks whose period is not in silver yet, and the newest one (SRC-13) -> their periods'
    partitions of silver replaced (MRG-05) -> (gold, rebuilt from silver every run (MRG-06); unreadable files)."""
    path = lake.path("silver", "Stock_Abonados_Silver")
    first = not table_exists(spark, path)
    cut = snapshot_cut(F.col("name"))
    files = list_files(spark, raw_path).select("path", "name", cut["label"].alias("periodo"), cut["cut"].alias("corte")).filter("periodo IS NOT NULL")
    if not first:
        loaded = read_table(spark, path).select(F.col("Quincena Evaluada").alias("periodo"))
        files = pending_snapshots(files, loaded, "periodo", "corte")
    rows, errors = read_workbooks(spark, raw_path, only=files.select("path"))
    replace_keys(spark, path, ST.merge_stock(None, ST.stock_silver(rows)), "Quincena Evaluada")
    return ST.stock_gold(read_table(spark, path), drop_null_keys=first), errors


def run_stock(spark: SparkSession, lake: Lake, raw_path: str) -> list[dict]:
    """PL-14 as a job of its own."""
    gold, errors = stock_tables(spark, lake, raw_path)
    return _publish(lake, {"Stock_Abonados_Gold": ("gold", gold)}) + _unreadable(errors)


@dataclass
class Reports:
    """Where the extracts of each job lie, and the parameters of the jobs."""

    folders: dict[str, str]
    as_of: _dt.date
    ticket_rules: T.TicketRules
    own_offices: list[str] = field(default_factory=list)
    office_sellers: list[str] = field(default_factory=list)
    own_sellers: list[str] = field(default_factory=list)
    listing_overrides: list = field(default_factory=list)
    bank_targets: list[str] = field(default_factory=list)
    care_excluded: list[str] = field(default_factory=list)
    ont_response: str = "ONT APAGADA"
    employee_exclude: str | None = None
    offices_csv: str | None = None


def report_jobs(spark: SparkSession, r: Reports) -> list[Job]:
    """The jobs of the suite: each merges its extracts into bronze (by their date column, where they have one) and gives
    its tables; those that build on other jobs' tables read these from the lake."""
    def bronze(lake: Lake, folder: str, table: str, date_col: str | None = None) -> DataFrame:
        ingest(spark, lake, r.folders[folder], table, date_col)
        return read_table(spark, lake.path("bronze", table))

    def gold(name: str, table: str, date_col: str | None, build, bronze_table: str, needs: tuple[str, ...] = ()) -> Job:
        return Job(name, lambda lake: {("gold", table): build(lake, bronze(lake, name, bronze_table, date_col))}, needs)

    def collections(lake: Lake) -> dict:
        hours = bronze(lake, "payment_hours", "Horas_Raw_Bronze", "Fecha") if "payment_hours" in r.folders else None
        return {("gold", "Recaudacion_Gold"): CO.collections_gold(bronze(lake, "collections", "Recaudacion_Raw_Bronze", "Fecha"), hours, r.own_offices)}

    def claims(lake: Lake) -> dict:
        parts = {k: bronze(lake, f"claims_{k}", f"Reclamos_{k}_Raw_Bronze", "Fecha Llamada") for k in ("general", "app", "bank") if f"claims_{k}" in r.folders}
        out = {("gold", "Reclamos_General_Gold"): CL.claims_general({"general": parts["general"]})}
        if "app" in parts:
            out["gold", "Reclamos_App_Gold"] = CL.app_faults(parts["app"])
        if "bank" in parts:
            out["gold", "Reclamos_Banco_Gold"] = CL.bank_faults(parts["bank"], r.bank_targets)
        return out

    def customers(lake: Lake, rows: DataFrame) -> DataFrame:
        known = lake.read("gold", "Dim_Cliente").select("N° Abonado", "Cliente_SK") if lake.exists("gold", "Dim_Cliente") else None
        return PE.customer_dimension(rows, known)

    def updates(lake: Lake) -> dict:
        feeds = [bronze(lake, f"updates_{k}", f"ActDatos_{k}_Bronze", d) for k, d in (("calls", "Fecha Llamada"), ("observations", "Fecha"))]
        return {("gold", "Actualizacion_Datos_Gold"): CL.data_updates(*feeds)}

    def stock(lake: Lake) -> dict:
        return {("gold", "Stock_Abonados_Gold"): stock_tables(spark, lake, r.folders["stock"])[0]}

    def tickets(lake: Lake) -> dict:
        rows, _ = read_workbooks(spark, r.folders["tickets"], exclude=("consolidado",))
        out = T.build(rows, r.ticket_rules)
        return {("silver" if k == "Tickets_Silver_Master" else "gold", k): df for k, df in out.items()}

    def franchises(lake: Lake) -> dict:
        return {("gold", "Dim_Franquicias"): ST.franchise_dim(lake.read("gold", "Stock_Abonados_Gold"), lake.read("gold", "IDF_Gold"))}

    def statistics(lake: Lake) -> dict:
        rows, _ = read_workbooks(spark, r.folders["yearly_statistics"])
        files = list_files(spark, r.folders["yearly_statistics"]).withColumn("Fecha", date_token(F.col("name")))
        newest = latest_per_year(files, "Fecha").select(F.regexp_extract("path", r"([^/\\]+)$", 1).alias("path"), F.col("anio").alias("Anio"), "Fecha")
        wide = rows.join(newest.select(F.col("path").alias("Source.Name"), "Anio"), "Source.Name")
        history, summary = ST.yearly_statistics(newest, wide)
        return {("gold", "Estadistica_Abonados_Historico"): history, ("gold", "Estadistica_Abonados_Resumen"): summary}

    def traffic(lake: Lake) -> dict:
        golds = {"RECAUDACIÓN": "Recaudacion_Gold", "VENTAS": "Ventas_Estatus_Gold", "ATENCIÓN AL CLIENTE": "Atencion_Cliente_Gold"}
        universe = read_workbooks(spark, r.folders["advisers"])[0] if "advisers" in r.folders else None
        return {("silver", "Afluencia_Consolidada_Silver"): TR.traffic_silver({k: lake.read("gold", t) for k, t in golds.items()}, lake.read("gold", "Maestro_Empleados_Gold"), universe)}

    def traffic_gold(lake: Lake) -> dict:
        g, audit = TR.traffic_gold(lake.read("silver", "Afluencia_Consolidada_Silver"), read_dimension_csv(spark, r.offices_csv))
        return {("gold", "Afluencia_Gold"): g, ("gold", "Oficinas_Sin_Mapa"): audit}

    return [
        gold("employees", "Maestro_Empleados_Gold", None, lambda _, b: PE.employee_master(b, r.employee_exclude), "Maestro_Empleados_Raw_Bronze"),
        gold("customers", "Dim_Cliente", "Fecha Contrato", customers, "Dim_Cliente_Raw_Bronze"),
        Job("collections", collections),
        gold("sales_listing", "Ventas_Listado_Gold", "Fecha Contrato", lambda _, b: SA.sales_listing(b, r.office_sellers, r.own_sellers, r.listing_overrides), "Ventas_Listado_Bronze"),
        gold("sales_status", "Ventas_Estatus_Gold", "Fecha Venta", lambda _, b: SA.sales_status(b), "Ventas_Estatus_Bronze"),
        Job("claims", claims),
        gold("care", "Atencion_Cliente_Gold", "Fecha Llamada", lambda _, b: CL.customer_care(b, r.care_excluded), "Atencion_Cliente_Raw_Bronze"),
        gold("collection_calls", "Llamadas_Cobranza_Gold", "Fecha Llamada", lambda _, b: CO.collection_calls_gold(b, r.as_of), "Cobranza_Raw_Bronze"),
        Job("data_updates", updates),
        gold("win_back", "ComeBackHome_Gold", "Fecha Llamada", lambda _, b: CL.win_back(b, r.as_of), "ComeBackHome_Raw_Bronze"),
        gold("ont_off", "ONT_OFF_Gold", "Fecha Llamada", lambda lake, b: CL.ont_off(b, lake.read("gold", "Atencion_Cliente_Gold"), r.ont_response), "ONT_OFF_Raw_Bronze", ("care",)),
        Job("stock", stock),
        Job("tickets", tickets),
        Job("franchises", franchises, ("stock", "tickets")),
        Job("yearly_statistics", statistics),
        Job("traffic_silver", traffic, ("employees", "collections", "sales_status", "care")),
        Job("traffic_gold", traffic_gold, ("traffic_silver",)),
    ]


def newest_workbook(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-12: the most recently modified workbook of a folder (one row)."""
    return latest_file(list_files(spark, folder))


def today() -> _dt.date:
    """The run date, taken once by the caller and passed down as ``as_of``."""
    return _dt.date.today()
