"""Domain jobs (PL-*) run on report-shaped inputs derived from the driver
tables. Operator-level oracles live in the other proof modules; here most jobs
are checked by row count, a few with a full SQL oracle."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

from ..functions.core import c
from ..plans import calls as CL
from ..plans import collections as CO
from ..plans import people as PE
from ..plans import sales as SA
from ..plans import stock as ST
from ..plans import suite as SU
from ..plans import traffic as TR
from ..operators.rules import TOPIC_DEFAULT, TOPIC_RULES
from ..session import Tables, checkpoint_root
from ..sources import files as SF
from ..sources.lake import Lake
from . import proof


NAMES_SQL = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"


def _calls_from_events(t, with_mtime=True):
    e = t.events
    cols = [F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("N° Abonado"),
            F.replace(F.format_number(F.col("user_id") * 1000 + 3, 0), F.lit(","), F.lit(".")).alias("Documento"),
            F.concat(F.lit("Cliente "), F.col("user_id").cast("string")).alias("Cliente"),
            F.when(F.col("user_id") % 9 == 0, "CORTADO").otherwise("ACTIVO").alias("Estatus"),
            F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")).alias("Saldo"),
            F.date_format("ts", "dd/MM/yyyy").alias("Fecha Llamada"), F.date_format("ts", "HH:mm:ss").alias("Hora Llamada"),
            F.lit("ENTRANTE").alias("Tipo Llamada"), F.upper("event_type").alias("Tipo Respuesta"),
            F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("FALLA CON "), F.upper("event_type"))).alias("Detalle Respuesta"),
            F.when(F.col("event_id") % 3 == 0, "call agente").otherwise("asesor ofi").alias("Responsable"),
            F.lit("HOGAR").alias("Suscripción"), F.lit("GA").alias("Grupo Afinidad"),
            F.concat(F.lit("FR"), (F.col("user_id") % 5).cast("string")).alias("Franquicia"), F.lit("CIUDAD").alias("Ciudad")]
    if with_mtime:
        cols.append(F.col("ts").alias("Fecha_Modificacion_Archivo"))
    return e.select(*cols)


@proof("PL-01", """WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS pid, CAST(o_custkey AS VARCHAR) AS ab, CAST(o_orderdate AS DATE) AS fecha,
  o_totalprice AS total, 'OFICINA ' || CAST(o_custkey % 10 AS VARCHAR) AS ofi, o_orderpriority AS vend, o_orderstatus AS est FROM orders
  WHERE NOT regexp_matches('OFICINA ' || CAST(o_custkey % 10 AS VARCHAR), '(?i)OFICINA 9')),
h AS (SELECT CAST(l_orderkey AS VARCHAR) AS k, max(strftime(l_shipdate + to_hours(l_linenumber), '%H:%M:%S')) AS hora FROM lineitem GROUP BY 1)
SELECT NULL::VARCHAR AS "ID Contrato", ab AS "N° Abonado", fecha AS "Fecha", total AS "Total Pago", '' AS "Forma de Pago", '' AS "Banco",
  ofi AS "Oficina", NULL::VARCHAR AS "Fecha Contrato", est AS "Estatus", '' AS "Suscripción", '' AS "Grupo Afinidad",
  '' AS "Nombre Franquicia", '' AS "Ciudad", vend AS "Vendedor", 'RECAUDACIÓN' AS "Tipo de afluencia",
  CASE WHEN ofi IN ('OFICINA 1', 'OFICINA 2') THEN 'OFICINAS PROPIAS' ELSE 'ALIADOS Y DESARROLLO' END AS "Clasificacion",
  coalesce(substr(h.hora, 1, 2) || ':00', '00:00') AS "Hora de Pago"
FROM p LEFT JOIN h ON p.pid = h.k""")
def pl01(spark, d):
    t = Tables(spark, d)
    o = t.orders
    pay = o.select(
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")))
         .otherwise(F.col("o_orderkey").cast("string")).alias("Nro Recibo"),
        F.col("o_custkey").cast("string").alias("N° Abonado"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Fecha"),
        F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("Total Pago"),
        F.concat(F.lit("OFICINA "), (F.col("o_custkey") % 10).cast("string")).alias("Oficina Cobro"),
        F.col("o_orderpriority").alias("Cobrador"), F.col("o_orderstatus").alias("Estatus"))
    hours = t.lineitem.select(F.col("l_orderkey").cast("string").alias("ID Pago"),
                              F.date_format(F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber")),
                                            "HH:mm:ss").alias("Hora de Pago"))
    return CO.collections_gold(pay, hours, ["OFICINA 1", "OFICINA 2"], exclude_office_regex="OFICINA 9")


@proof("PL-02", f"""WITH s AS (SELECT CAST(o_custkey AS VARCHAR) || 'A' AS ab, CAST(o_orderdate AS DATE) AS fc, o_orderstatus AS est,
  CASE o_orderkey % 5 WHEN 0 THEN 'televentas norte' WHEN 1 THEN 'ventas  calle' WHEN 2 THEN lower(o_orderpriority)
    WHEN 3 THEN 'montalto ofic' ELSE '' END AS vend,
  CASE WHEN o_orderkey % 5 = 3 THEN 'OFICINA MONTALTO' WHEN o_totalprice > 300000 THEN 'ASESOR ' || CAST(o_custkey AS VARCHAR) ELSE '' END AS nd,
  CASE WHEN o_orderkey % 5 = 3 THEN 'Oficina Detectada' WHEN o_totalprice > 300000 THEN 'Exacta'
    WHEN o_totalprice > 250000 THEN 'Pendiente de Revisión' ELSE 'No detectado' END AS tipo,
  CASE WHEN o_orderkey % 5 = 3 THEN 'MONTALTO' WHEN o_orderkey % 2 = 0 THEN 'OFI ' || CAST(o_custkey % 4 AS VARCHAR) ELSE '' END AS ofi,
  CASE WHEN o_orderkey % 3 = 0 THEN 'CORO' WHEN o_orderkey % 3 = 1 THEN 'NAN' ELSE '' END AS ciu,
  o_orderdate + to_seconds(o_orderkey % 60) AS mt FROM orders),
c AS (SELECT *, CASE WHEN contains(vend, 'televentas') OR contains(vend, 'call center') THEN 'CALL CENTER'
   WHEN (nd <> '' AND tipo <> 'Pendiente de Revisión' AND tipo <> 'No detectado'
     AND NOT contains(vend, 'administrador')) OR vend IN ('2-high') THEN 'OFICINA COMERCIAL'
   WHEN (contains(vend, 'ventas') AND NOT contains(vend, 'televentas')) OR vend IN ('5-low') THEN 'VENDEDORES PROPIOS'
   ELSE 'ALIADOS' END AS canal FROM s WHERE tipo <> 'Pendiente de Revisión'),
r AS (SELECT *, row_number() OVER (PARTITION BY ab, fc ORDER BY mt DESC NULLS LAST, est, ciu, vend, nd, ofi, tipo) AS rn FROM c)
SELECT ab AS "N° Abonado", fc AS "Fecha Contrato", est AS "Estatus", NULL::VARCHAR AS "Suscripción",
  NULL::VARCHAR AS "Grupo Afinidad", NULL::VARCHAR AS "Nombre Franquicia", nullif(nullif(ciu, ''), 'NAN') AS "Ciudad", nullif(vend, '') AS "Vendedor",
  nullif(nd, '') AS "nombre_detectado", nullif(ofi, '') AS "Oficina", tipo AS "tipo_coincidencia", 'VENTAS' AS "Tipo de afluencia",
  {NAMES_SQL}[month(fc)] AS "Mes", canal AS "Canal" FROM r WHERE rn = 1""")
def pl02(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey") % 5
    key = F.col("o_custkey").cast("string")
    vend = (F.when(k == 0, " Televentas Norte").when(k == 1, "Ventas  Calle ").when(k == 2, F.lower("o_orderpriority"))
            .when(k == 3, "Montalto OFIC"))
    bronze = o.select(F.lit("x").alias("ID"), F.concat(F.lit(" "), key, F.lit("a")).alias("N° Abonado"), F.concat(F.lit("cliente  "), key).alias("Cliente"),
                      F.date_format("o_orderdate", "dd/MM/yyyy").alias("Fecha Contrato"), F.col("o_orderstatus").alias("Estatus"),
                      vend.alias("Vendedor"), F.when(F.col("o_orderkey") % 3 == 0, " coro").when(F.col("o_orderkey") % 3 == 1, "nan").alias("Ciudad"),
                      F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("ofi "), (F.col("o_custkey") % 4).cast("string"))).alias("oficina_comercial"),
                      F.when(F.col("o_totalprice") > 300000, "Exacta").when(F.col("o_totalprice") > 250000, "Pendiente de Revisión")
                       .otherwise("No detectado").alias("tipo_coincidencia"), F.lit("99").alias("fuzzy_score_nombre"),
                      F.when(F.col("o_totalprice") > 300000, F.concat(F.lit("asesor "), key)).alias("nombre_detectado"),
                      (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") % 60))
                      .alias("Fecha_Modificacion_Archivo"))
    place = {"Oficina": "MONTALTO", "tipo_coincidencia": "Oficina Detectada", "nombre_detectado": "OFICINA MONTALTO"}
    return SA.sales_listing(bronze, ["2-high"], ["5-low"], overrides=[(["montalto", "ofic"], place)])


@proof("PL-03", """WITH s AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS fv,
  CASE WHEN o_orderkey % 12 + 1 = 12 THEN '12:00' ELSE lpad(CAST(o_orderkey % 12 + 13 AS VARCHAR), 2, '0') || ':00' END AS hv,
  CASE o_orderkey % 5 WHEN 0 THEN 'VENDEDOR OFICINA CENTRO' WHEN 1 THEN 'OFI  NORTE' WHEN 2 THEN 'CALLE' WHEN 3 THEN 'AGENTE OFI SUR' END AS vend,
  CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS ab, o_orderstatus AS est, o_orderdate AS mt, o_custkey FROM orders
  WHERE o_orderkey % 7 <> 0),
f AS (SELECT *, nullif(trim(regexp_extract(vend, '.*(?:OFICINA|OFIC|OFI)\\s+(.*)$', 1)), '') AS ofi FROM s WHERE vend LIKE '%OFI%' AND vend NOT LIKE '%AGENTE%'),
r AS (SELECT *, row_number() OVER (PARTITION BY ab, fv, hv ORDER BY mt DESC NULLS LAST, est, vend) AS rn FROM f)
SELECT ab AS "N° Abonado", CAST(o_custkey AS VARCHAR) AS "Documento", est AS "Estatus", fv AS "Fecha", vend AS "Vendedor", NULL::VARCHAR AS "Costo",
  NULL::VARCHAR AS "Grupo Afinidad", 'FR' AS "Nombre Franquicia", NULL::VARCHAR AS "Ciudad", hv AS "Hora", 'Ventas' AS "Tipo de afluencia", ofi AS "Oficina"
FROM r WHERE rn = 1""")
def pl03(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey") % 5
    bronze = o.select(F.when(F.col("o_orderkey") % 17 > 0, F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Fecha Venta"),
                      F.concat((F.col("o_orderkey") % 12 + 1).cast("string"), F.lit(":15 p. m.")).alias("Hora venta"),
                      F.when(k == 0, " Vendedor OFICINA CENTRO").when(k == 1, "ofi  Norte").when(k == 2, "calle").when(k == 3, "Agente ofi sur").alias("Vendedor"),
                      F.when(F.col("o_orderkey") % 7 == 0, "Plan Play").otherwise("Plan Hogar").alias("Paquete/Servicio"),
                      F.when(F.col("o_custkey") % 50 > 0, F.col("o_custkey").cast("string")).alias("N° Abonado"), F.col("o_orderstatus").alias("Estatus"),
                      F.col("o_custkey").cast("string").alias("Cédula"), F.lit("FR").alias("Franquicia"),
                      F.col("o_orderdate").alias("Fecha_Modificacion_Archivo"))
    return SA.sales_status(bronze, exclude_package_regex="PLAN PLAY")


EVB_SQL = """b AS (SELECT CAST(user_id AS VARCHAR) || '.0' AS ab, replace(format('{:,}', user_id * 1000 + 3), ',', '.') AS doc,
  'Cliente ' || CAST(user_id AS VARCHAR) AS cli, CASE WHEN user_id % 9 = 0 THEN 'CORTADO' ELSE 'ACTIVO' END AS est,
  replace(CAST(value AS VARCHAR), '.', ',') AS saldo, value, CAST(date_trunc('day', ts) AS TIMESTAMP) AS f, CAST(ts AS DATE) AS fd,
  strftime(ts, '%H') || ':00' AS h, strftime(ts, '%H:%M:%S') AS hraw, upper(event_type) AS tr,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'FALLA CON ' || upper(event_type) END AS det,
  CASE WHEN event_id % 3 = 0 THEN 'call agente' ELSE 'asesor ofi' END AS resp, 'FR' || CAST(user_id % 5 AS VARCHAR) AS fr,
  ts AS mt, month(ts) AS m FROM events)"""


@proof("PL-04", "WITH " + EVB_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY ab, f, hraw ORDER BY mt DESC NULLS LAST, est, saldo, tr, det, resp) AS rn FROM b)
SELECT ab AS "N° Abonado", est AS "Estatus", saldo AS "Saldo", f AS "Fecha Llamada", h AS "Hora Llamada", 'ENTRANTE' AS "Origen",
  tr AS "Tipo Respuesta", det AS "Detalle Respuesta", resp AS "Responsable", 'HOGAR' AS "Suscripción", 'GA' AS "Grupo Afinidad",
  fr AS "Franquicia", 'CIUDAD' AS "Ciudad" FROM r WHERE rn = 1""")
def pl04(spark, d):
    calls = _calls_from_events(Tables(spark, d))
    return CL.claims_general({"generales": calls.filter(F.col("Franquicia") != "FR0"), "app": calls.filter(F.col("Franquicia") == "FR0")})


@proof("PL-05", "WITH " + EVB_SQL + """,
c AS (SELECT *, upper(coalesce(det, 'nan')) AS det2 FROM b),
k AS (SELECT *, count(det2) OVER (PARTITION BY det2) AS oc FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY ab, f, hraw ORDER BY mt DESC NULLS LAST, doc, est, saldo, det2, resp) AS rn FROM k)
SELECT ab AS "N° Abonado", doc AS "Documento", cli AS "Cliente", est AS "Estatus", saldo AS "Saldo", f AS "Fecha Llamada",
  h AS "Hora Llamada", CASE WHEN det2 = 'NAN' THEN NULL ELSE det2 END AS "Detalle Respuesta", resp AS "Responsable",
  'HOGAR' AS "Suscripción", 'GA' AS "Grupo Afinidad", fr AS "Franquicia", 'CIUDAD' AS "Ciudad", oc AS "OrdenCategoria"
FROM r WHERE rn = 1""")
def pl05(spark, d):
    return CL.app_faults(_calls_from_events(Tables(spark, d)))


ABBR = "['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SEP','OCT','NOV','DIC']"


@proof("PL-06", """WITH b AS (SELECT CAST(user_id AS VARCHAR) || '.0' AS ab, 'Cliente ' || CAST(user_id AS VARCHAR) AS cli,
  CASE WHEN user_id % 9 = 0 THEN 'CORTADO' ELSE 'ACTIVO' END AS est, replace(CAST(value AS VARCHAR), '.', ',') AS saldo,
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS f, strftime(ts, '%H') || ':00' AS h, strftime(ts, '%H:%M:%S') AS hraw,
  upper(event_type) AS tr, CASE WHEN event_id % 7 = 0 THEN 'NAN' ELSE 'FALLA CON ' || upper(event_type) END AS det0,
  CASE WHEN event_id % 3 = 0 THEN 'call agente' ELSE 'asesor ofi' END AS resp, 'FR' || CAST(user_id % 5 AS VARCHAR) AS fr, ts AS mt
  FROM events),
t AS (SELECT *, trim(replace(replace(det0, 'FALLA CON ', ''), 'FALLA ', '')) AS det FROM b WHERE det0 IN ('FALLA CON ERROR', 'FALLA CON PURCHASE')),
c AS (SELECT *, count(*) OVER (PARTITION BY det) AS tc FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY ab, f, hraw ORDER BY mt DESC NULLS LAST, ab, cli, est, saldo, f, hraw, tr, det, resp, fr, tc) AS rn FROM c)
SELECT ab AS "N° Abonado", cli AS "Cliente", est AS "Estatus", saldo AS "Saldo", f AS "Fecha Llamada", h AS "Hora Llamada",
  'ENTRANTE' AS "Tipo Llamada", tr AS "Tipo Respuesta", det AS "Detalle Respuesta", resp AS "Responsable",
  NULL::VARCHAR AS "Observación", 'GA' AS "Grupo Afinidad", fr AS "Franquicia", 'CIUDAD' AS "Ciudad", tc AS "TotalCuenta"
FROM r WHERE rn = 1""")
def pl06(spark, d):
    return CL.bank_faults(_calls_from_events(Tables(spark, d)), ["FALLA CON ERROR", "FALLA CON PURCHASE"])


CARE_SQL = """
c AS (SELECT *, replace(regexp_replace(trim(ab), '\\.0$', ''), '.', '') AS ab2, replace(regexp_replace(trim(doc), '\\.0$', ''), '.', '') AS doc2
  FROM b WHERE tr IS NULL OR tr NOT IN ({excluded})),
r AS (SELECT *, row_number() OVER (PARTITION BY ab2, f, hraw ORDER BY mt DESC NULLS LAST, doc2, cli, est, tr, det NULLS FIRST, resp) AS rn FROM c),
d AS (SELECT * FROM r WHERE rn = 1)"""


@proof("PL-07", "WITH " + EVB_SQL + "," + CARE_SQL.format(excluded="'SIGNUP'") + """,
k AS (SELECT tr, count(*) AS n FROM d WHERE tr IS NOT NULL GROUP BY 1),
rk AS (SELECT tr, dense_rank() OVER (ORDER BY n DESC) AS rango FROM k)
SELECT ab2 AS "N° Abonado", doc2 AS "Documento", cli AS "Cliente", est AS "Estatus", f AS "Fecha", h AS "Hora",
  'ENTRANTE' AS "Tipo Llamada", d.tr AS "Tipo Respuesta", det AS "Detalle Respuesta", upper(resp) AS "Vendedor", 'HOGAR' AS "Suscripción",
  'GA' AS "Grupo Afinidad", fr AS "Nombre Franquicia", 'CIUDAD' AS "Ciudad", 'ATENCIÓN AL CLIENTE' AS "Tipo de afluencia",
  NULL::VARCHAR AS "Observación", CAST(coalesce(rk.rango, 0) AS INTEGER) AS "RankingMotivo"
FROM d LEFT JOIN rk ON d.tr = rk.tr""")
def pl07(spark, d):
    return CL.customer_care(_calls_from_events(Tables(spark, d)), exclude_responses=["SIGNUP"])


# the report has cleaned ids and whole hours here, so that its keys meet those of the care gold
@proof("PL-08", "WITH " + EVB_SQL + "," + CARE_SQL.format(excluded="''") + """,
a AS (SELECT regexp_replace(ab, '\\.0$', '') AS ab2, doc AS doc2, cli, est, f, h, tr, det, resp, fr, 0 AS care FROM b WHERE tr <> 'CLICK'
  UNION ALL SELECT ab2, doc2, cli, est, f, h, tr, det, upper(resp), fr, 1 FROM d WHERE tr = 'CLICK'),
r2 AS (SELECT *, row_number() OVER (PARTITION BY ab2, f, h ORDER BY care DESC, doc2, cli, est, tr, det NULLS FIRST, resp) AS rn FROM a)
SELECT ab2 AS "N° Abonado", doc2 AS "Documento", cli AS "Cliente", est AS "Estatus", f AS "Fecha", h AS "Hora", 'ENTRANTE' AS "Tipo Llamada",
  tr AS "Tipo Respuesta", det AS "Detalle Respuesta", resp AS "Vendedor", 'HOGAR' AS "Suscripción", 'GA' AS "Grupo Afinidad",
  fr AS "Nombre Franquicia", 'CIUDAD' AS "Ciudad" FROM r2 WHERE rn = 1""")
def pl08(spark, d):
    calls = _calls_from_events(Tables(spark, d))
    report = calls.filter(F.col("Tipo Respuesta") != "CLICK").withColumns({
        "N° Abonado": F.regexp_replace("N° Abonado", r"\.0$", ""),
        "Hora Llamada": F.concat(F.substring("Hora Llamada", 1, 2), F.lit(":00"))})
    return CL.ont_off(report, CL.customer_care(calls), "CLICK")


@proof("PL-09", "WITH " + EVB_SQL + """,
c AS (SELECT *, regexp_replace(ab, '\.0$', '') AS ab2,
  CASE WHEN regexp_matches(resp, '(?i)CALL|PHONE') THEN 'CALL CENTER' WHEN regexp_matches(resp, '(?i)OFI|ASESOR') THEN 'OFICINA COMERCIAL'
  ELSE 'ALIADOS' END AS canal FROM b WHERE fd < DATE '2024-01-27'),
r AS (SELECT *, row_number() OVER (PARTITION BY ab2, fd, h ORDER BY mt DESC NULLS LAST, doc, est, saldo, tr, det NULLS FIRST, resp) AS rn FROM c)
SELECT ab2 AS "N° Abonado", doc AS "Documento", est AS "Estatus", saldo AS "Saldo", fd AS "Fecha Llamada", h AS "Hora", 'ENTRANTE' AS "Tipo Llamada",
  tr AS "Tipo Respuesta", det AS "Detalle Respuesta", resp AS "Responsable", 'HOGAR' AS "Suscripción", 'GA' AS "Grupo Afinidad", fr AS "Franquicia",
  'CIUDAD' AS "Ciudad", mt AS "Fecha_Modificacion_Archivo", canal AS "Canal" FROM r WHERE rn = 1""")
def pl09(spark, d):
    return CO.collection_calls_gold(_calls_from_events(Tables(spark, d)), dt.date(2024, 1, 25))


@proof("PL-10", "WITH " + EVB_SQL + """,
ca AS (SELECT 'DATA - ACTUALIZACION DATOS.XLSX' AS origen, ab, est, CASE WHEN tr = 'CLICK' THEN NULL ELSE f END AS f, hraw AS hora,
  ['CAMBIO DE EMAIL', 'CELULAR', 'CÉDULA DE IDENTIDAD', 'NÚMERO TELEFÓNICO', 'DIRECCION ANT:', NULL]
  [CAST(substr(hraw, 7, 2) AS INTEGER) % 6 + 1] AS det, CASE WHEN tr = 'VIEW' THEN NULL ELSE tr END AS tr, resp, 'HOGAR' AS sus, 'GA' AS ga, fr,
  'CIUDAD' AS ciu, mt FROM b),
ob AS (SELECT 'DATA - GESTION OBS.XLSX', CAST(conv_id AS VARCHAR), NULL, TIMESTAMP '2024-01-01', lpad(CAST(turn % 24 AS VARCHAR), 2, '0') || ':00',
  CASE """ + " ".join(f"WHEN regexp_matches(upper(coalesce(tx, '')), '{p}') THEN '{lab}'" for p, lab in TOPIC_RULES)
    + f" ELSE '{TOPIC_DEFAULT}' END" + """, 'GESTION INTERNA / OBS', NULL, NULL, NULL, 'FR 9', NULL, NULL::TIMESTAMP
  FROM (SELECT *, CASE WHEN turn % 3 = 0 THEN 'nuevo correo' ELSE text END AS tx FROM conversations)),
u AS (SELECT * FROM ca UNION ALL SELECT * FROM ob),
v AS (SELECT * REPLACE (replace(replace(replace(replace(coalesce(det, ''), 'EMAIL', 'CORREO ELECTRÓNICO'), 'CÉDULA DE IDENTIDAD', 'CEDULA'), 'CELULAR', 'TELEFONO'),
  'NÚMERO TELEFÓNICO', 'TELEFONO') AS det, coalesce(tr, 'SIN CLASIFICAR') AS tr) FROM u),
r AS (SELECT *, row_number() OVER (PARTITION BY ab, f, hora ORDER BY mt DESC NULLS LAST, origen, est NULLS FIRST, det NULLS FIRST, tr NULLS FIRST,
  resp NULLS FIRST, fr) AS rn FROM v)
SELECT origen AS "Origen", ab AS "N° Abonado", est AS "Estatus", f AS "Fecha", substr(hora, 1, 2) || ':00' AS "Hora", nullif(det, '') AS "Detalle Respuesta",
  tr AS "Tipo Respuesta", resp AS "Responsable", sus AS "Suscripción", ga AS "Grupo Afinidad", fr AS "Nombre Franquicia", ciu AS "Ciudad"
FROM r WHERE rn = 1""")
def pl10(spark, d):
    t = Tables(spark, d)
    calls = _calls_from_events(t).withColumn("Source.Name", F.lit("Data - Actualizacion Datos.xlsx"))
    details = F.array(*[F.lit(x) for x in ["cambio de email", "Celular ", "Cédula de identidad ANT: 123", "NÚMERO TELEFÓNICO", "direccion ANT: "]], F.lit(None).cast("string"))
    calls = calls.withColumns({"Detalle Respuesta": F.element_at(details, (F.substring("Hora Llamada", 7, 2).cast("int") % 6 + 1).cast("int")),
                               "Fecha Llamada": F.when(F.col("Tipo Respuesta") != "CLICK", F.col("Fecha Llamada")),
                               "Tipo Respuesta": F.when(F.col("Tipo Respuesta") != "VIEW", F.lower("Tipo Respuesta"))})
    obs = t.conversations.select(F.col("conv_id").cast("string").alias("N° Abonado"), F.lit("01/01/2024").alias("Fecha"),
                                 F.concat(F.lpad((F.col("turn") % 24).cast("string"), 2, "0"), F.lit(":00")).alias("Hora"),
                                 F.when(F.col("turn") % 3 != 0, F.col("text")).alias("Observacion"), F.lit("nuevo correo").alias("Asunto"),
                                 F.lit("FR 9").alias("Franquicia"), F.lit("Data - Gestion OBS.xlsx").alias("Source.Name"))
    return CL.data_updates(calls, obs)


@proof("PL-11", """WITH s AS (SELECT CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS ab,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS f,
  lpad(CAST(o_orderkey % 3 AS VARCHAR), 2, '0') || ':30' AS hraw, o_orderstatus AS est, upper(trim(o_orderpriority)) AS tr, o_orderdate AS mt FROM orders),
w AS (SELECT * FROM s WHERE f IS NULL OR f < TIMESTAMP '2000-07-02'),
r AS (SELECT *, row_number() OVER (PARTITION BY ab, f, hraw ORDER BY mt DESC NULLS LAST, est NULLS FIRST, tr NULLS FIRST) AS rn FROM w)
SELECT 'Data - Come Back Home.xlsx' AS "Source.Name", ab AS "N° Abonado", NULL::VARCHAR AS "Documento", 'CLIENTE   X' AS "Cliente", est AS "Estatus",
  f AS "Fecha", substr(hraw, 1, 2) || ':00' AS "Hora", tr AS "Tipo Respuesta", NULL::VARCHAR AS "Detalle Respuesta",
  'ASESOR' AS "Responsable", NULL::VARCHAR AS "Suscripción", NULL::VARCHAR AS "Grupo Afinidad", 'FR 1' AS "Nombre Franquicia",
  NULL::VARCHAR AS "Ciudad", 'COME BACK HOME' AS "Tipo de afluencia" FROM r WHERE rn = 1""")
def pl11(spark, d):
    o = Tables(spark, d).orders
    bronze = o.select(F.lit("Data - Come Back Home.xlsx").alias("Source.Name"),
                      F.when(F.col("o_custkey") % 50 == 0, F.lit("nan")).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("N° Abonado"),
                      F.lit("  cliente   x ").alias("Cliente"),
                      F.when(F.col("o_orderkey") % 11 == 0, F.lit("sin fecha")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Fecha Llamada"),
                      F.concat(F.lpad((F.col("o_orderkey") % 3).cast("string"), 2, "0"), F.lit(":30")).alias("Hora Llamada"),
                      F.col("o_orderstatus").alias("Estatus"), F.col("o_orderpriority").alias("Tipo Respuesta"),
                      F.lit("asesor").alias("Responsable"), F.lit(" fr 1").alias("Franquicia"),
                      F.col("o_orderdate").alias("Fecha_Modificacion_Archivo"))
    return CL.win_back(bronze, dt.date(2000, 6, 30))


@proof("PL-12", """WITH a AS (SELECT s_name, s_suppkey, n_name AS sae, 'SISTEMA ' || n_name AS sis, DATE '2024-03-01' AS fi, 1 AS mt FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT s_name, s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'OFICINA ESTE' ELSE n_name END, 'TARDE', DATE '2024-04-01', 2
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0
  UNION ALL SELECT s_name, s_suppkey, n_name, 'MAÑANA', DATE '2024-04-01', 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0),
f AS (SELECT CAST(s_suppkey AS VARCHAR) AS doc, upper(s_name) AS nc, sae, sis, fi, upper(s_name) || ' ' || sae AS comb, mt FROM a
  WHERE NOT regexp_matches(s_name, '(?i)#0+9\\b')),
r AS (SELECT *, row_number() OVER (PARTITION BY doc, comb, fi ORDER BY mt DESC) AS rn FROM f),
l AS (SELECT *, lead(fi) OVER (PARTITION BY comb ORDER BY fi) AS fin FROM r WHERE rn = 1)
SELECT doc AS "Doc_Identidad", nc AS "Nombre_Completo", comb AS "Combinado", sae AS "OficinaSae", sis AS "OficinaSistema", fi AS "Fecha_Inicio",
  fin AS "Fecha_Fin", CASE WHEN fin IS NULL THEN 'ACTIVO' ELSE 'HISTÓRICO' END AS "Estado_Vigencia" FROM l""")
def pl12(spark, d):
    t = Tables(spark, d)
    base = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))

    def snapshot(rows, office, system, day, mtime):
        return rows.select(F.col("s_suppkey").cast("string").alias("doc. de identidad"), F.lower("s_name").alias(" nombre"),
                           office.alias("apellido"), system.alias("oficina"), F.lit(f"Data - Empleados {day}.xlsx").alias("Source.Name"),
                           F.lit(mtime).alias("Fecha_Modificacion_Archivo"))

    later = base.filter(F.col("s_acctbal") > 0)
    moved = F.when(F.col("s_acctbal") > 5000, F.lit("oficina este")).otherwise(F.col("n_name"))
    a = snapshot(base, F.col("n_name"), F.concat(F.lit("Sistema "), F.col("n_name")), "01-03-2024", 1)
    b = snapshot(later, moved, F.lit("tarde"), "1-4-2024", 2).unionByName(snapshot(later, F.col("n_name"), F.lit("mañana"), "1-4-2024", 1))
    whole = snapshot(base, F.lit("ninguna"), F.lit("ninguno"), "05-05-2024", 9).withColumn("Source.Name", F.lit("Data - CONSOLIDADO 05-05-2024.xlsx"))
    return PE.employee_master(a.unionByName(b).unionByName(whole), exclude_regex=r"#0+9\b")


@proof("PL-13", """WITH prev AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_custkey * 2 AS sk FROM customer WHERE c_acctbal > 0),
cur AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_name || ' 2' AS n FROM customer UNION ALL
  SELECT '1.' || CAST(c_custkey AS VARCHAR), c_name FROM customer WHERE c_custkey % 10 = 1),
m AS (SELECT max(sk) AS mx FROM prev)
SELECT cur.k AS "N° Abonado", n AS "Cliente", prev.sk AS "Cliente_SK" FROM cur JOIN prev ON cur.k = prev.k
UNION ALL SELECT k, n, mx + row_number() OVER (ORDER BY k) FROM cur, m WHERE k NOT IN (SELECT k FROM prev)""")
def pl13(spark, d):
    cu = Tables(spark, d).customer
    key, source = F.col("c_custkey").cast("string"), F.lit("f.xlsx").alias("Source.Name")

    def version(rows, k, name, mtime):
        return rows.select(k.alias("N° Abonado"), name.alias("Cliente"), source, F.lit(mtime).alias("Fecha_Modificacion_Archivo"))

    cur = (version(cu, F.concat(key, F.lit(".0")), F.concat("c_name", F.lit(" 2")), 2).unionByName(version(cu, key, F.col("c_name"), 1))
           .unionByName(version(cu.filter("c_custkey % 10 = 1"), F.concat(F.lit("1."), key), F.col("c_name"), 1)))
    prev = cu.filter(F.col("c_acctbal") > 0).select(key.alias("N° Abonado"), (F.col("c_custkey") * 2).alias("Cliente_SK"))
    return PE.customer_dimension(cur, prev)


def _snapshots(t):
    o = t.orders
    return o.select(
        F.concat(F.lit("Data - Abonados hasta el "), F.date_format("o_orderdate", "d.MM.yyyy"), F.lit(".xlsx")).alias("Source.Name"),
        F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") == "F", " activo ").otherwise("CORTADO").alias("Estatus contrato"),
        F.when(F.col("o_custkey") % 5 > 0, F.concat(F.lit(" fr"), (F.col("o_custkey") % 5).cast("string"))).alias("Nombre Franquicia"),
        F.when(F.col("o_orderkey") % 13 == 0, "PRUEBA DE INTERNET").when(F.col("o_orderkey") % 2 == 0, "OTRO").alias("Detalle Orden"))


@proof("PL-14", f"""WITH s AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_custkey % 5 > 0 THEN 'FR' || CAST(o_custkey % 5 AS VARCHAR)
  ELSE 'NO DEFINIDA' END AS fr FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 13 <> 0),
c AS (SELECT *, CAST(CASE WHEN day(d) <= 5 THEN date_trunc('month', d) - INTERVAL 1 DAY WHEN day(d) <= 20
  THEN date_trunc('month', d) + INTERVAL 14 DAY ELSE last_day(d) END AS DATE) AS cut,
  CASE WHEN day(d) > 5 AND day(d) <= 20 THEN 'Q1' ELSE 'Q2' END AS q FROM s)
SELECT {ABBR}[month(cut)] || ' ' || CAST(year(cut) AS VARCHAR) || ' ' || q AS "Quincena Evaluada", fr AS "Franquicia",
  count(DISTINCT CAST(o_custkey AS VARCHAR)) AS "Total_Abonados", max(CAST(cut AS TIMESTAMP)) AS "Fecha_Corte" FROM c GROUP BY 1, 2""")
def pl14(spark, d):
    silver = ST.stock_silver(_snapshots(Tables(spark, d)))
    return ST.stock_gold(ST.merge_stock(None, silver))


@proof("PL-16", """SELECT DISTINCT franquicia FROM (SELECT n_name AS franquicia FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer cu ON cu.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = cu.c_nationkey
  UNION SELECT 'FR' || CAST(o_custkey % 5 AS VARCHAR) FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 5 > 0 AND o_orderkey % 13 <> 0) WHERE franquicia IS NOT NULL ORDER BY 1""")
def pl16(spark, d):
    t = Tables(spark, d)
    from .tickets import ticket_rows
    stock = ST.stock_gold(ST.stock_silver(_snapshots(t)))
    return ST.franchise_dim(stock, ticket_rows(t)).withColumnRenamed("Franquicia", "franquicia")


@proof("PL-17", """WITH w AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'ACTIVO' WHEN 'O' THEN 'CORTADO' ELSE 'OTRO' END AS est,
  CAST(year(o_orderdate) AS INTEGER) AS anio, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2, 3)
SELECT anio AS "Anio", count(*) AS "Registros", CAST(sum(n) AS BIGINT) AS "Total" FROM w
WHERE est IN ('ACTIVO', 'ANULADO', 'CORTADO') AND n > 0 GROUP BY 1""")
def pl17(spark, d):
    from ..functions.dates import MONTHS_ES, month_name_es
    o = Tables(spark, d).orders
    st = F.when(F.col("o_orderstatus") == "F", "ACTIVO").when(F.col("o_orderstatus") == "O", "CORTADO").otherwise("OTRO")
    wide = (o.withColumn("mes", month_name_es(F.month("o_orderdate"), "upper"))
            .groupBy(st.alias("ESTATUS"), F.year("o_orderdate").alias("Anio"))
            .pivot("mes", [m.upper() for m in MONTHS_ES]).agg(F.count(F.lit(1))))
    wide = wide.withColumn("Source.Name", F.concat(F.lit("Data_Abonados3112"), F.col("Anio").cast("string"), F.lit(".xlsx")))
    files = wide.select(c("Source.Name").alias("path"),
                        F.to_date(F.concat(F.col("Anio").cast("string"), F.lit("-12-31"))).alias("Fecha")).distinct()
    latest = SF.latest_per_year(files, "Fecha")
    rows, summary = ST.yearly_statistics(latest, wide)
    return summary


from ..functions.clean import ACCENTED, PLAIN  # noqa: E402

_FOLD_VEND = (f"trim(regexp_replace(regexp_replace(translate(lower(vend), '{ACCENTED}', '{PLAIN}'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))")
# sellers: an employee's name with a word more, an adviser's name the other way round, keywords, and nobody's names
TRAFFIC_CTE = f"""WITH g AS (SELECT CAST(o_custkey AS VARCHAR) AS ab, o_orderstatus AS est, CAST(o_orderdate AS DATE) AS fecha,
  CASE o_orderkey % 5 WHEN 0 THEN lower(o_orderpriority) WHEN 1 THEN 'agente ' || CAST(o_custkey AS VARCHAR)
    WHEN 2 THEN 'Supplier ' || lpad(CAST(o_custkey % 150 AS VARCHAR), 9, '0') || ' zona' WHEN 3 THEN lpad(CAST(o_custkey % 150 AS VARCHAR), 9, '0') || '  ASESOR'
    ELSE 'Call Center ' || CAST(o_custkey % 3 AS VARCHAR) END AS vend, o_orderkey % 5 AS kind, o_custkey % 150 AS nn,
  'NATION_' || CAST(o_custkey % 25 AS VARCHAR) AS ofi0, CASE WHEN o_orderstatus = 'F' THEN 'RECAUDACIÓN' ELSE 'VENTAS' END AS tipo FROM orders),
q AS (SELECT *, upper({_FOLD_VEND}) AS uq FROM g),
e AS (SELECT s_suppkey, 'R' || CAST(s_nationkey AS VARCHAR) AS ofe FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey % 7 <> 0),
u AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'NATION_3' ELSE 'U' || CAST(s_nationkey AS VARCHAR) END AS ofu FROM supplier WHERE s_suppkey % 2 = 1),
s AS (SELECT q.*, CASE WHEN e.ofe IS NOT NULL THEN e.ofe WHEN u.ofu IS NOT NULL THEN u.ofu
  WHEN contains(uq, 'INTERCOM') OR contains(uq, 'INVERSIONES') OR contains(uq, 'SOLUCIONES') OR contains(uq, 'TECNOLOGIA')
    OR contains(uq, 'AGENTE') OR contains(uq, 'COMERCIALIZADORA') THEN 'ALIADO / AGENTE'
  WHEN contains(uq, 'CALLE') THEN 'FUERZA DE VENTA EXTERNA'
  WHEN contains(uq, 'TELEVENTAS') OR contains(uq, 'CALL CENTER') THEN 'TELEVENTAS / CALL CENTER' ELSE ofi0 END AS ofi
  FROM q LEFT JOIN e ON kind = 2 AND nn = e.s_suppkey LEFT JOIN u ON kind = 3 AND nn = u.s_suppkey)"""
TRAFFIC_COLS_SQL = ('ab AS "N° Abonado", NULL::VARCHAR AS "Documento", est AS "Estatus", fecha AS "Fecha", vend AS "Vendedor", '
                    'NULL::VARCHAR AS "Grupo Afinidad", NULL::VARCHAR AS "Nombre Franquicia", NULL::VARCHAR AS "Ciudad", '
                    'tipo AS "Tipo de afluencia"')
MONTH_LOWER_SQL = ("lower(['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre',"
                   "'Noviembre','Diciembre'][month(fecha)])")


def _traffic_inputs(t):
    o = t.orders
    k = F.col("o_orderkey") % 5
    number = F.lpad((F.col("o_custkey") % 150).cast("string"), 9, "0")
    vend = (F.when(k == 0, F.lower("o_orderpriority")).when(k == 1, F.concat(F.lit("agente "), F.col("o_custkey").cast("string")))
            .when(k == 2, F.concat(F.lit("Supplier "), number, F.lit(" zona"))).when(k == 3, F.concat(number, F.lit("  ASESOR")))
            .otherwise(F.concat(F.lit("Call Center "), (F.col("o_custkey") % 3).cast("string"))))
    gold = o.select(F.col("o_custkey").cast("string").alias("N° Abonado"), F.col("o_orderstatus").alias("Estatus"),
                    F.to_date("o_orderdate").alias("Fecha"), vend.alias("Vendedor"),
                    F.concat(F.lit("NATION_"), (F.col("o_custkey") % 25).cast("string")).alias("Oficina"))
    s, own = t.supplier, F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
    emp = s.filter("s_suppkey % 2 = 0").select(
        F.concat(F.lit("SUPPLIER "), own, F.when(F.col("s_suppkey") % 7 == 0, " INTERCOM").otherwise("")).alias("Nombre_Completo"),
        F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("OficinaSistema"))
    univ = s.filter("s_suppkey % 2 = 1").select(F.lit("Asesor").alias("Nombre"), own.alias("Apellido"),
        F.when(F.col("s_suppkey") % 5 == 0, "NATION_3").otherwise(F.concat(F.lit("U"), F.col("s_nationkey").cast("string"))).alias("Oficina"))
    return {"RECAUDACIÓN": gold.filter(F.col("Estatus") == "F"), "VENTAS": gold.filter(F.col("Estatus") != "F")}, emp, univ


@proof("PL-18", TRAFFIC_CTE + f"""
SELECT {TRAFFIC_COLS_SQL}, ofi AS "Oficina", NULL::VARCHAR AS "Clasificacion", NULL::VARCHAR AS "Hora", {MONTH_LOWER_SQL} AS "Mes" FROM s""")
def pl18(spark, d):
    return TR.traffic_silver(*_traffic_inputs(Tables(spark, d)))


@proof("PL-19", TRAFFIC_CTE + f""",
m AS (SELECT upper(trim(n_name)) AS k, max(lower(n_name)) AS nombre, max('R' || CAST(n_regionkey AS VARCHAR)) AS estado, max('SEDE') AS tipo_sede
  FROM nation WHERE n_regionkey <> 4 GROUP BY 1)
SELECT {TRAFFIC_COLS_SQL}, CASE WHEN m.k IS NOT NULL THEN m.nombre ELSE s.ofi END AS "Oficina", NULL::VARCHAR AS "Clasificacion",
  NULL::VARCHAR AS "Hora", {MONTH_LOWER_SQL} AS "Mes", CASE WHEN m.k IS NOT NULL THEN m.estado ELSE 'Sin Asignar' END AS "Estado_Sede",
  CASE WHEN m.k IS NOT NULL THEN m.tipo_sede ELSE 'Sin Asignar' END AS "Tipo_Sede"
FROM s LEFT JOIN m ON upper(trim(s.ofi)) = m.k""")
def pl19(spark, d):
    return _traffic_gold(spark, d)[0]


@proof("PL-19-audit", TRAFFIC_CTE + """ SELECT DISTINCT ofi AS valor FROM s
WHERE ofi IS NOT NULL AND upper(trim(ofi)) NOT IN (SELECT upper(trim(n_name)) FROM nation WHERE n_regionkey <> 4)""")
def pl19_audit(spark, d):
    return _traffic_gold(spark, d)[1].select("valor")


def _traffic_gold(spark, d):
    t = Tables(spark, d)
    silver = TR.traffic_silver(*_traffic_inputs(t))
    offices = t.nation.filter(F.col("n_regionkey") != 4).select(
        F.col("n_name").alias("Input_Original"), F.lower("n_name").alias("Nombre_Normalizado_Final"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("Estado"), F.lit("SEDE").alias("Tipo_Sede"))
    return TR.traffic_gold(silver, offices)


# the suite's jobs, each with its table and the entry whose inputs and SQL stand for it here
SUITE = {
    "employees": ("gold", "Maestro_Empleados_Gold", "PL-12", ()), "customers": ("gold", "Dim_Cliente", "PL-13", ()),
    "collections": ("gold", "Recaudacion_Gold", "PL-01", ()), "sales_listing": ("gold", "Ventas_Listado_Gold", "PL-02", ()),
    "sales_status": ("gold", "Ventas_Estatus_Gold", "PL-03", ()), "claims": ("gold", "Reclamos_General_Gold", "PL-04", ()),
    "care": ("gold", "Atencion_Cliente_Gold", "PL-07", ()), "collection_calls": ("gold", "Llamadas_Cobranza_Gold", "PL-09", ()),
    "data_updates": ("gold", "Actualizacion_Datos_Gold", "PL-10", ()), "win_back": ("gold", "ComeBackHome_Gold", "PL-11", ()),
    "ont_off": ("gold", "ONT_OFF_Gold", "PL-08", ("care",)), "stock": ("gold", "Stock_Abonados_Gold", "PL-14", ()),
    "tickets": ("gold", "SLA_Gold", "PL-15", ()), "franchises": ("gold", "Dim_Franquicias", "PL-16", ("stock", "tickets")),
    "yearly_statistics": ("gold", "Estadistica_Abonados_Resumen", "PL-17", ()),
    "traffic_silver": ("silver", "Afluencia_Consolidada_Silver", "PL-18", ("employees", "collections", "sales_status", "care")),
    "traffic_gold": ("gold", "Afluencia_Gold", "PL-19", ("traffic_silver",)),
}


def _suite_sql() -> str:
    from . import REGISTRY
    rows = [f"SELECT '{job}' AS job, 'ok' AS estado, '{table}' AS tabla, (SELECT count(*) FROM ({REGISTRY[entry][1]}) t) AS filas"
            for job, (_layer, table, entry, _needs) in SUITE.items()]
    broken = [("sin_insumo", "error"), ("depende", "omitida")]
    rows += [f"SELECT '{job}', '{state}', NULL, NULL FROM region WHERE r_regionkey = 0" for job, state in broken]
    return " UNION ALL ".join(rows)


@proof("PL-21", _suite_sql())
def pl21(spark, d):
    """All jobs of the suite, published and counted; a job without its extracts fails, and what needs it is skipped."""
    from . import REGISTRY

    def build(layer, table, entry):
        return lambda lake: {(layer, table): lake.spark.createDataFrame([], "x int") if entry is None else REGISTRY[entry][0](spark, d)}

    jobs = [SU.Job(job, build(layer, table, entry), needs) for job, (layer, table, entry, needs) in SUITE.items()]
    lake = Lake(spark, f"{checkpoint_root(spark).rstrip('/')}/strata-suite-{uuid.uuid4().hex[:12]}")
    offices = Tables(spark, d).nation.filter(F.col("n_regionkey") != 4).select(
        F.col("n_name").alias("Input_Original"), F.lower("n_name").alias("Nombre_Normalizado_Final"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("Estado"), F.lit("SEDE").alias("Tipo_Sede"))
    # the gold traffic is made of the silver table that the suite itself has published
    jobs = [j if j.name != "traffic_gold" else SU.Job(j.name, lambda lake: {("gold", "Afluencia_Gold"): TR.traffic_gold(lake.read("silver", "Afluencia_Consolidada_Silver"), offices)[0]}, j.needs) for j in jobs]
    jobs += [SU.Job("depende", build("gold", "Nada", None), ("sin_insumo",)), SU.Job("sin_insumo", lambda lake: {("gold", "Nada"): lake.read("gold", "Falta")})]
    return SU.run_suite(spark, lake, jobs).select("job", "estado", "tabla", "filas")
