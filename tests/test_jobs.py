"""End-to-end domain jobs on literal bronze rows."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.rules import ticket_rules
from strata.plans import tickets as T

D = dt.datetime

COLS = ("`Source.Name` string, `N° Orden` string, `N° Contrato` string, `Fecha Creacion` string, `Fecha Impresion` string, "
        "`Fecha Finalizacion` string, `Grupo Trabajo` string, `Usuario Final` string, `Solucion Aplicada` string, "
        "`Detalle Orden` string, Estatus_orden string, Franquicia string, `Grupo Afinidad` string")


def test_ticket_job_end_to_end(spark):
    q1 = "Data - IdF 1-12-2025 al 15-12-2025.xlsx"
    q2 = "Data - IdF 16-12-2025 al 31-12-2025.xlsx"
    rows = [
        # closed inside Q1, printed: resolution 120 min, dispatch 60
        (q1, "100.0", "7", "02/12/2025 08:00", "02/12/2025 09:00", "02/12/2025 10:00", "CAMPO", "tecnico1", "CAMBIO DE CABLE",
         "SIN SERVICIO", "FINALIZADA", "F1", "G"),
        # same order opened in Q1 still open -> backlog row in Q1 (the closed row wins the dedupe)
        (q1, "100", "7", "02/12/2025 08:00", None, None, "CAMPO", "tecnico1", None, "SIN SERVICIO", "ABIERTA", "F1", "G"),
        # Excel serial dates, closed in Q2, never printed -> dispatch 0, administrative -> not a fault
        (q2, "200", "8", "46007", None, "46008.5", "MESA", "noc user", "CONSULTA DE SALDO", "SALDO", "FINALIZADA", "F2", "G"),
        # excluded by status
        (q2, "300", "9", "17/12/2025 08:00", None, None, "MESA", "x", None, "SIN SERVICIO", "ANULADA", "F2", "G"),
        # opened before the window and still open -> dropped by the backlog filter
        (q2, "400", "9", "01/11/2025 08:00", None, None, "MESA", "x", None, "SIN SERVICIO", "ABIERTA", "F2", "G"),
        # file without a period -> dropped
        ("otro.xlsx", "500", "9", "17/12/2025 08:00", None, None, "MESA", "x", None, "X", "ABIERTA", "F2", "G"),
    ]
    bronze = spark.createDataFrame(rows, COLS)
    rules = T.TicketRules(classification=ticket_rules(admin=["CONSULTA DE SALDO"], noc_users=["NOC USER"],
                                                      physical=["CABLE"], logical=["RESET"]))
    out = T.build(bronze, rules)
    silver = {(r["Quincena Evaluada"], r["N° Orden"]): r for r in out["Tickets_Silver_Master"].collect()}
    assert set(silver) == {("DIC 2025 Q1", "100"), ("DIC 2025 Q2", "200")}
    a = silver[("DIC 2025 Q1", "100")]
    assert (a[T.RES], a[T.DISP], a[T.PRINT], a["Clasificacion"], a["Es_Falla"], a["Cumplio_SLA"]) == \
        (120.0, 60.0, 60.0, "OPERACIONES", 1, 1)
    b = silver[("DIC 2025 Q2", "200")]
    assert b[T.OPENED] == D(2025, 12, 16) and b[T.CLOSED] == D(2025, 12, 17, 12)  # Excel serials 46007 / 46008.5
    assert (b[T.RES], b[T.DISP], b[T.PRINT], b["Clasificacion"], b["Es_Falla"]) == (2160.0, 0.0, 2160.0, "ADMINISTRATIVO", 0)
    sla = {(r["Quincena Evaluada"], r["Franquicia"]): r["Total_Ordenes"] for r in out["SLA_Gold"].collect()}
    assert sla == {("DIC 2025 Q1", "F1"): 1, ("DIC 2025 Q2", "F2"): 1}
    detail = out["IDF_Gold_Detalle_Solucion"].collect()
    assert [(r["Solucion Aplicada"], r["Total_Ordenes"]) for r in detail] == [("CAMBIO DE CABLE", 1)]
    assert out["Tickets_Fact_Gold"].count() == 2 and out["SLA_GOLD_STATS"].count() == 2
    idf = {r["Quincena Evaluada"]: r["Total_Fallas"] for r in out["IDF_Gold"].collect()}
    assert idf == {"DIC 2025 Q1": 1, "DIC 2025 Q2": 1}


def test_failure_index(spark):
    idf = spark.createDataFrame([("Q", "F1", 3), ("Q", "F2", 1)], "`Quincena Evaluada` string, Franquicia string, Total_Fallas long")
    stock = spark.createDataFrame([("Q", "F1", 30)], "`Quincena Evaluada` string, Franquicia string, Total_Abonados long")
    got = {r.Franquicia: r.IDF for r in T.failure_index(idf, stock).collect()}
    assert got == {"F1": 0.1, "F2": None}


def test_run_tickets_from_workbooks(spark, tmp):
    from strata.plans.runner import run_tickets
    from strata.sources.lake import Lake

    from .test_io import make_xlsx

    hdr = ["N° Orden", "Fecha Creacion", "Fecha Impresion", "Fecha Finalizacion", "Grupo Trabajo", "Usuario Final",
           "Solucion Aplicada", "Detalle Orden", "Estatus_orden", "Franquicia"]
    make_xlsx(f"{tmp}/Data - IdF 1-12-2025 al 15-12-2025.xlsx",
              [hdr, ["1", "02/12/2025 08:00", None, "02/12/2025 09:00", "CAMPO", "u", "CABLE", "X", "FIN", "F1"],
               ["2", "03/12/2025 08:00", None, None, "CAMPO", "u", None, "X", "ABIERTA", "F1"]])
    lake = Lake(spark, f"{tmp}/lake")
    rules = T.TicketRules(classification=ticket_rules(admin=["SALDO"], noc_users=[], physical=["CABLE"], logical=[]))
    audit = {a["table"]: a for a in run_tickets(spark, lake, f"{tmp}/*.xlsx", rules)}
    assert audit["SLA_Gold"]["rows"] == 1 and audit["Tickets_Fact_Gold"]["rows"] == 2
    assert lake.read("silver", "Tickets_Silver_Master").count() == 2


def test_alerts_and_profile(spark):
    from strata.plans import calls as CL
    from strata.plans import sales as SA

    calls = spark.createDataFrame([("1", "01/01/2024", "10:00", "x")], "`N° Abonado` string, `Fecha Llamada` string, "
                                  "`Hora Llamada` string, `Tipo Llamada` string")
    alerts = []
    out = CL.claims_general({"a": calls}, alerts=alerts)
    assert out.count() == 1 and "Saldo" in alerts and "Origen" not in alerts
    st_alerts = []
    SA.sales_status(spark.createDataFrame([("OFI X", "1")], "Vendedor string, `N° Abonado` string"), alerts=st_alerts)
    assert "Costo" in st_alerts and "Vendedor" not in st_alerts
    prof = CL.ont_off_profile(spark.createDataFrame([("1", 2.0), ("2", 4.0)], "a string, b double"))
    assert {r.column: r["count"] for r in prof.collect()} == {"a": 2, "b": 2}


def test_run_stock_and_collections_from_workbooks(spark, tmp):
    import os

    from strata.plans.runner import run_collections, run_stock
    from strata.sources.lake import Lake

    from tests.test_io import make_xlsx

    lake = Lake(spark, f"{tmp}/lake")
    os.makedirs(f"{tmp}/stock")
    make_xlsx(f"{tmp}/stock/Data - Abonados hasta el 3-1-2026.xlsx",
              [["Id", "Estatus contrato", "Nombre Franquicia"], ["1", "ACTIVO", "F1"], ["2", " activo ", "F1"], ["3", "CORTADO", "F2"]])
    make_xlsx(f"{tmp}/stock/Data - Abonados hasta el 18-1-2026.xlsx",
              [["ID", "Estatus", "Franquicia"], ["1", "ACTIVO", "F1"], ["4", "ACTIVO", "F2"]])
    audit = run_stock(spark, lake, f"{tmp}/stock")
    gold = {(r["Quincena Evaluada"], r["Franquicia"]): r["Total_Abonados"] for r in lake.read("gold", "Stock_Abonados_Gold").collect()}
    assert gold == {("DIC 2025 Q2", "F1"): 2, ("ENE 2026 Q1", "F1"): 1, ("ENE 2026 Q1", "F2"): 1}
    assert audit[0]["rows"] == 3

    os.makedirs(f"{tmp}/pay")
    os.makedirs(f"{tmp}/hours")
    make_xlsx(f"{tmp}/pay/Data - Recaudacion 1-1-2026 al 15-1-2026.xlsx",
              [["N° Abonado", "Nro Recibo", "Fecha", "Total Pago", "Oficina Cobro"], ["1", "10.0", "05/01/2026", "12,5", "OF A"],
               ["2", "11", "06/01/2026", "3", "OF B"], ["3", None, "06/01/2026", "1", "OF A"]])
    make_xlsx(f"{tmp}/hours/Data - HorasPago 1-1-2026 al 15-1-2026.xlsx",
              [["ID Pago", "Hora de Pago", "Fecha"], ["10", "2:30 p. m.", "05/01/2026"]])
    run_collections(spark, lake, f"{tmp}/pay", f"{tmp}/hours", ["OF A"])
    got = sorted((r["N° Abonado"], r["Total Pago"], r["Clasificacion"], r["Hora de Pago"])
                 for r in lake.read("gold", "Recaudacion_Gold").collect())
    assert got == [("1", 12.5, "OFICINAS PROPIAS", "14:00"), ("2", 3.0, "ALIADOS Y DESARROLLO", "00:00")]


def test_golds_feed_branch_traffic(spark):
    """PL-07 and PL-12 -> PL-18 -> PL-19: dates, hours and sellers arrive, offices are resolved by the employee master."""
    from strata.plans import calls as CL
    from strata.plans import people as PE
    from strata.plans import traffic as TR

    calls = spark.createDataFrame(
        [("7.0", "10/01/2024", "09:15:00", "ana gil norte", "RECLAMO"), ("8", "11/01/2024", "3:30 p. m.", "Agente X", "RECLAMO"),
         ("9", "12/01/2024", None, None, "PAGO DEL SERVICIO")],
        "`N° Abonado` string, `Fecha Llamada` string, `Hora Llamada` string, Responsable string, `Tipo Respuesta` string")
    staff = spark.createDataFrame([("Ana Gil", "Norte", "Oficina Norte", "1", "Data - Empleados 01-01-2024.xlsx")],
                                  "Nombre string, Apellido string, Oficina string, `Doc. De Identidad` string, `Source.Name` string")
    care = CL.customer_care(calls, exclude_responses=["PAGO DEL SERVICIO"])
    silver = TR.traffic_silver({"ATENCIÓN AL CLIENTE": care}, PE.employee_master(staff), None)
    got = {r["N° Abonado"]: r for r in silver.collect()}
    assert set(got) == {"7", "8"}
    assert all(r["Fecha"] is not None and r["Hora"] and r["Vendedor"] and r["Tipo de afluencia"] == "ATENCIÓN AL CLIENTE" for r in got.values())
    assert got["7"]["Oficina"] == "OFICINA NORTE" and got["8"]["Oficina"] == "ALIADO / AGENTE"
    offices = spark.createDataFrame([("oficina norte", "Sede Norte", "Lara", "Propia")],
                                    "Input_Original string, Nombre_Normalizado_Final string, Estado string, Tipo_Sede string")
    gold, audit = TR.traffic_gold(silver, offices)
    rows = {r["N° Abonado"]: (r["Oficina"], r["Estado_Sede"]) for r in gold.collect()}
    assert rows == {"7": ("Sede Norte", "Lara"), "8": ("ALIADO / AGENTE", "Sin Asignar")}
    assert [r.valor for r in audit.collect()] == ["ALIADO / AGENTE"]


def test_suite_order_skips_and_counts(spark, tmp):
    import pytest

    from strata.plans.suite import Job, in_order, run_suite
    from strata.sources.lake import Lake

    def table(n):
        return lambda lake: {("gold", f"T{n}"): lake.spark.range(n)}

    def broken(lake):
        raise RuntimeError("no extracts")

    jobs = [Job("last", lambda lake: {("gold", "L"): lake.read("gold", "T3")}, ("three", "four")), Job("three", table(3)), Job("four", table(4)),
            Job("after_broken", table(1), ("broken",)), Job("broken", broken), Job("further", table(1), ("after_broken",)), Job("none", table(0))]
    assert [j.name for j in in_order(jobs)] == ["three", "four", "last", "broken", "after_broken", "further", "none"]
    got = {r.job: (r.estado, r.tabla, r.filas) for r in run_suite(spark, Lake(spark, tmp), jobs).collect()}
    assert got == {"last": ("ok", "L", 3), "three": ("ok", "T3", 3), "four": ("ok", "T4", 4), "broken": ("error", None, None),
                   "after_broken": ("omitida", None, None), "further": ("omitida", None, None), "none": ("vacía", "T0", 0)}
    with pytest.raises(ValueError, match="each other"):
        in_order([Job("a", table(1), ("b",)), Job("b", table(1), ("a",))])
    with pytest.raises(ValueError, match="not there"):
        in_order([Job("a", table(1), ("b",))])


def test_report_jobs_from_workbooks(spark, tmp):
    """Two of the reports have their extracts; the others fail one by one, and what needs them is skipped."""
    import os

    from strata.plans.runner import Reports, report_jobs
    from strata.plans.suite import run_suite
    from strata.plans.tickets import TicketRules
    from strata.proofs.books import workbook
    from strata.sources.lake import Lake

    def put(folder, name, header, rows):
        os.makedirs(f"{tmp}/{folder}", exist_ok=True)
        with open(f"{tmp}/{folder}/{name}.xlsx", "wb") as f:
            f.write(workbook(header, rows))

    put("stock", "Abonados 3-2-2024", ["Id", "Estatus", "Franquicia"], [["1", "ACTIVO", "f1"], ["2", "CORTADO", "f1"]])
    put("stock", "Abonados 18-2-2024", ["Id", "Estatus", "Franquicia"], [["1", "ACTIVO", "f1"], ["3", "ACTIVO", "f2"]])
    put("collection_calls", "calls", ["N° Abonado", "Cliente", "Fecha Llamada", "Hora Llamada", "Responsable"], [["7.0", "x", ("date", 45292), "10:30:00", "asesor"]])
    lake = Lake(spark, f"{tmp}/lake")
    r = Reports({k: f"{tmp}/{k}" for k in ("stock", "collection_calls")}, dt.date(2024, 6, 1), TicketRules([]))
    jobs = report_jobs(spark, r)
    assert len(jobs) == 17
    got = {x.job: (x.estado, x.filas) for x in run_suite(spark, lake, jobs).collect()}
    assert got["stock"] == ("ok", 3) and got["collection_calls"] == ("ok", 1)
    assert got["care"][0] == "error" and got["ont_off"][0] == got["franchises"][0] == got["traffic_gold"][0] == "omitida"
    call = lake.read("gold", "Llamadas_Cobranza_Gold").first()
    assert (call["N° Abonado"], call["Fecha Llamada"], call["Hora"]) == ("7", dt.date(2024, 1, 1), "10:00")
    # the second run reads only the newest snapshot again
    os.utime(f"{tmp}/stock/Abonados 3-2-2024.xlsx")
    with open(f"{tmp}/stock/Abonados 3-2-2024.xlsx", "wb") as f:
        f.write(b"not read any more")
    again = {x.job: (x.estado, x.filas) for x in run_suite(spark, lake, [j for j in jobs if j.name == "stock"]).collect()}
    assert again["stock"] == ("ok", 3)
