"""PL-15 minimal slice on orders/lineitem: scan -> FLT-06 -> CLS-01
-> KPI-01..03 -> WIN-05 -> AGG-01 (SLA gold)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import c
from ..operators.filters import period_with_backlog
from ..operators.rules import Rule, classify
from ..plans import tickets as T
from ..session import Tables
from . import proof

PERIOD_LABEL = "JUN 1998 Q2"
OPEN_FROM = dt.datetime(1997, 1, 1)
CLOSE_FROM = dt.datetime(1997, 6, 1)
PERIOD_END = dt.datetime(1998, 6, 30)

# Synthetic classification rules for the driver tables (solution = p_type, group = priority).
PROOF_RULES = [
    Rule("Solucion Aplicada", "contains_any", ("PROMO",), "ADMINISTRATIVO"),
    Rule("Grupo Trabajo", "like_prefix", ("1-",), "NOC"),
    Rule("Solucion Aplicada", "contains_any", ("ECONOMY", "STANDARD"), "OPERACIONES"),
]


def ticket_rows(t: Tables) -> DataFrame:
    """Tickets from the driver tables: ticket = l_orderkey, opened = o_orderdate,
    closed = l_shipdate (NULL when key % 7 = 0), printed = opened + linenumber
    days (NULL when key % 5 = 0), solution = p_type, group = priority,
    franchise = nation of the customer."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = t.part.select("p_partkey", "p_type")
    cu = t.customer.select("c_custkey", "c_nationkey")
    na = t.nation.select("n_nationkey", "n_name")
    df = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
          .join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
          .join(cu, F.col("o_custkey") == F.col("c_custkey"), "left")
          .join(na, F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    return df.select(
        F.col("l_orderkey").alias("N° Orden"),
        F.col("o_orderdate").alias(T.OPENED),
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("l_shipdate")).alias(T.CLOSED),
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("o_orderdate") + F.make_dt_interval(F.col("l_linenumber"))).alias(T.PRINTED),
        F.col("p_type").alias("Solucion Aplicada"),
        F.col("o_orderpriority").alias("Grupo Trabajo"),
        F.col("n_name").alias("Franquicia"),
        "l_partkey", "l_extendedprice")


def silver_slice(t: Tables) -> DataFrame:
    df = ticket_rows(t).filter(period_with_backlog(c(T.OPENED), c(T.CLOSED), F.lit(OPEN_FROM), F.lit(PERIOD_END),
                                                   F.lit(CLOSE_FROM)))
    df = df.withColumns({"Quincena Evaluada": F.lit(PERIOD_LABEL), "FechaInicio": F.lit(OPEN_FROM),
                         "FechaFin": F.lit(PERIOD_END)}).withColumn("Clasificacion", classify(PROOF_RULES))
    df = T.ticket_flags(T.ticket_kpis(df))
    tie = [c("Solucion Aplicada").asc_nulls_first(), c("Grupo Trabajo").asc_nulls_first(),
           c(T.PRINTED).asc_nulls_first(), c("l_partkey").asc_nulls_first(), c("l_extendedprice").asc_nulls_first()]
    return T.dedupe_tickets(df, tie_break=tie)


TICKETS_CTE = """
WITH t AS (
  SELECT l.l_orderkey AS ticket, o.o_orderdate AS opened,
         CASE WHEN l.l_orderkey % 7 = 0 THEN NULL ELSE l.l_shipdate END AS closed,
         CASE WHEN l.l_orderkey % 5 = 0 THEN NULL ELSE o.o_orderdate + to_days(l.l_linenumber) END AS printed,
         p.p_type AS solution, o.o_orderpriority AS grp, n.n_name AS franchise, l.l_partkey, l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN customer cu ON cu.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = cu.c_nationkey
), f AS (
  SELECT * FROM t
  WHERE (closed IS NOT NULL AND closed >= TIMESTAMP '1997-06-01' AND closed < TIMESTAMP '1998-07-01')
     OR (opened >= TIMESTAMP '1997-01-01' AND opened < TIMESTAMP '1998-07-01' AND closed IS NULL)
), m AS (
  SELECT *,
    CASE WHEN upper(solution) LIKE '%PROMO%' THEN 'ADMINISTRATIVO'
         WHEN upper(grp) LIKE '1-%' THEN 'NOC'
         WHEN upper(solution) LIKE '%ECONOMY%' OR upper(solution) LIKE '%STANDARD%' THEN 'OPERACIONES'
         ELSE 'N/S' END AS cls,
    CASE WHEN closed IS NULL OR opened IS NULL THEN NULL
         ELSE greatest(round_even(date_diff('microsecond', opened, closed) / 60000000.0::DOUBLE, 2), 0.0) END AS res,
    CASE WHEN closed IS NULL OR printed IS NULL THEN NULL
         ELSE greatest(round_even(date_diff('microsecond', printed, closed) / 60000000.0::DOUBLE, 2), 0.0) END AS des0,
    CASE WHEN printed IS NULL OR opened IS NULL THEN NULL
         ELSE greatest(round_even(date_diff('microsecond', opened, printed) / 60000000.0::DOUBLE, 2), 0.0) END AS imp0
  FROM f
), k AS (
  SELECT *,
    CASE WHEN closed IS NOT NULL THEN coalesce(res, 0.0) ELSE res END AS res_c,
    CASE WHEN closed IS NOT NULL AND printed IS NULL THEN 0.0
         WHEN closed IS NOT NULL THEN coalesce(des0, 0.0) ELSE des0 END AS des_c
  FROM m
), s AS (
  SELECT *,
    CASE WHEN closed IS NOT NULL THEN least(des_c, res_c) ELSE des0 END AS des,
    CASE WHEN closed IS NOT NULL THEN res_c - least(des_c, res_c) ELSE imp0 END AS imp,
    row_number() OVER (PARTITION BY ticket ORDER BY closed DESC NULLS LAST, solution ASC NULLS FIRST,
        grp ASC NULLS FIRST, printed ASC NULLS FIRST, l_partkey ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST) AS rn
  FROM k
), silver AS (
  SELECT * FROM s WHERE rn = 1
)
"""


@proof("PL-15", TICKETS_CTE + """
SELECT 'JUN 1998 Q2' AS quincena_evaluada, franchise AS franquicia, cls AS clasificacion,
       CAST(opened AS DATE) AS fecha_apertura_date, count(DISTINCT ticket) AS total_ordenes,
       round(sum(res), 2) AS sla_resolucion_min, round(sum(des), 2) AS sla_despacho_min,
       round(sum(imp), 2) AS sla_impresion_min
FROM silver WHERE res IS NOT NULL AND res > 0 AND franchise IS NOT NULL
GROUP BY franchise, cls, CAST(opened AS DATE)
""")
def pl15_sla_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = T.sla_gold(silver_slice(Tables(spark, sf_dir)))
    return g.select(
        c("Quincena Evaluada").alias("quincena_evaluada"), c("Franquicia").alias("franquicia"),
        c("Clasificacion").alias("clasificacion"), c("Fecha Apertura Date").alias("fecha_apertura_date"),
        c("Total_Ordenes").alias("total_ordenes"),
        F.round(c(T.RES), 2).alias("sla_resolucion_min"), F.round(c(T.DISP), 2).alias("sla_despacho_min"),
        F.round(c(T.PRINT), 2).alias("sla_impresion_min"))


# ---------------------------------------------------------------- the whole job, from text bronze to each table

BOOKS = {0: ("Data - Ordenes 1-1-1997 al 15-6-1998.xlsx", "JUN 1998 Q1"), 1: ("Data - Ordenes 16-6-1997 al 30-6-1998.xlsx", "JUN 1998 Q2")}
JOB_RULES = T.TicketRules(PROOF_RULES, exclude_solutions=["medium"], exclude_group_contains=["5-L"], exclude_detail_equals=["Brand#9"])


def ticket_books(t: Tables) -> DataFrame:
    """The tickets as all-text rows of two period workbooks: dates as text or as day serials, ids with a trailing ``.0``."""
    df = ticket_rows(t)
    brand = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("Detalle Orden"))
    df = df.join(brand, "l_partkey", "left")
    k = c("N° Orden")

    def text(x):
        serial = F.concat(F.datediff(x, F.lit("1899-12-30").cast("date")).cast("string"), F.lit(".0"))
        return F.when((k % 3 == 0) & (F.year(x) >= 1996), serial).otherwise(F.date_format(x, "dd/MM/yyyy HH:mm:ss"))

    return df.select(
        F.when(k % 2 == 0, BOOKS[0][0]).otherwise(BOOKS[1][0]).alias("Source.Name"),
        F.concat(k.cast("string"), F.when(k % 4 == 0, ".0").otherwise("")).alias("N° Orden"), (k % 97).cast("string").alias("N° Contrato"),
        F.when(k % 11 == 0, "ANULADA").when(k % 11 == 1, "En creación").otherwise("CERRADA").alias("Estatus_orden"),
        text(c(T.OPENED)).alias("Fecha Creacion"), text(c(T.PRINTED)).alias("Fecha Impresion"), text(c(T.CLOSED)).alias("Fecha Finalizacion"),
        "Solucion Aplicada", "Grupo Trabajo", "Franquicia", "Detalle Orden", F.lit("nan").alias("Grupo Afinidad"), F.lit("u").alias("Usuario Final"))


JOB_CTE = TICKETS_CTE.split("), f AS (")[0] + """), f AS (
  SELECT t.*, p_brand AS detail, CASE WHEN ticket % 2 = 0 THEN 'JUN 1998 Q1' ELSE 'JUN 1998 Q2' END AS per,
    CASE WHEN ticket % 2 = 0 THEN TIMESTAMP '1997-01-01' ELSE TIMESTAMP '1997-06-16' END AS fi,
    CASE WHEN ticket % 2 = 0 THEN TIMESTAMP '1998-06-15' ELSE TIMESTAMP '1998-06-30' END AS ff FROM t LEFT JOIN part ON p_partkey = l_partkey
  WHERE ticket % 11 > 1 AND upper(coalesce(solution, '')) <> 'MEDIUM' AND NOT contains(upper(coalesce(grp, '')), '5-L') AND upper(coalesce(p_brand, '')) <> 'BRAND#9'
), w AS (
  SELECT * FROM f WHERE (closed IS NOT NULL AND closed >= CASE WHEN ticket % 2 = 0 THEN TIMESTAMP '1998-06-01' ELSE TIMESTAMP '1998-06-16' END AND closed < ff + INTERVAL 1 DAY)
     OR (opened >= fi AND opened < ff + INTERVAL 1 DAY AND closed IS NULL)
), m AS (""" + TICKETS_CTE.split("), m AS (")[1].replace("FROM f\n", "FROM w\n").replace(
    "PARTITION BY ticket ORDER BY closed DESC NULLS LAST, solution ASC NULLS FIRST,\n        grp ASC NULLS FIRST, printed ASC NULLS FIRST, l_partkey ASC NULLS FIRST, l_extendedprice ASC NULLS FIRST",
    "PARTITION BY per, ticket ORDER BY closed DESC NULLS LAST, printed ASC NULLS FIRST, CASE WHEN cls = 'ADMINISTRATIVO' THEN 0 ELSE 1 END, des ASC NULLS FIRST, imp ASC NULLS FIRST, cls, solution ASC NULLS FIRST, detail ASC NULLS FIRST").replace(
    "FROM k\n)", "FROM k0\n)").replace("), s AS (\n  SELECT *,\n    CASE WHEN closed IS NOT NULL THEN least", "), k0 AS (\n  SELECT *,\n    CASE WHEN closed IS NOT NULL THEN least").replace(
    "    row_number()", "    0 AS zero FROM k\n), s AS (\n  SELECT *, row_number()")
_SILVER = """per AS "Quincena Evaluada", fi AS "FechaInicio", ff AS "FechaFin", opened AS "Fecha Apertura", printed AS "Fecha Impresion", closed AS "Fecha Cierre",
  CAST(opened AS DATE) AS "Fecha Apertura Date", CAST(closed AS DATE) AS "Fecha Cierre Date", CASE WHEN cls = 'ADMINISTRATIVO' THEN 0 ELSE 1 END AS "Es_Falla",
  CASE WHEN res / 60 > 0 AND res / 60 <= 24.0 THEN 1 ELSE 0 END AS "Cumplio_SLA", res / 60 AS "Duracion_Horas", res AS "SLA Resolucion Min",
  des AS "SLA Despacho Min", imp AS "SLA Impresion Min", franchise AS "Franquicia", grp AS "Grupo Trabajo", NULL::VARCHAR AS "Grupo Afinidad", cls AS "Clasificacion",
  CAST(ticket % 97 AS VARCHAR) AS "N° Contrato", CAST(ticket AS VARCHAR) AS "N° Orden", 'CERRADA' AS "Estatus_orden", 'u' AS "Usuario Final",
  solution AS "Solucion Aplicada", detail AS "Detalle Orden" """
_JOB = JOB_CTE + f", o AS (SELECT {_SILVER} FROM silver) "


def _job(spark, sf_dir, table):
    return T.build(ticket_books(Tables(spark, sf_dir)), JOB_RULES)[table]


@proof("PL-15-silver", _JOB + "SELECT * FROM o")
def pl15_silver(spark, sf_dir):
    return _job(spark, sf_dir, "Tickets_Silver_Master")


@proof("PL-15-sla", _JOB + """SELECT "Quincena Evaluada", "Franquicia", "Clasificacion", "Fecha Apertura Date", count(DISTINCT "N° Orden") AS "Total_Ordenes",
  round(sum("SLA Resolucion Min"), 2) AS "SLA Resolucion Min", round(sum("SLA Despacho Min"), 2) AS "SLA Despacho Min", round(sum("SLA Impresion Min"), 2) AS "SLA Impresion Min"
  FROM o WHERE "SLA Resolucion Min" > 0 AND "Franquicia" IS NOT NULL GROUP BY 1, 2, 3, 4""")
def pl15_sla(spark, sf_dir):
    g = _job(spark, sf_dir, "SLA_Gold")
    return g.withColumns({n: F.round(c(n), 2) for n in (T.RES, T.DISP, T.PRINT)})


@proof("PL-15-idf", _JOB + """SELECT "Quincena Evaluada", "Franquicia", "Fecha Apertura Date", "Fecha Cierre Date", count(DISTINCT "N° Orden") AS "Total_Fallas"
  FROM o GROUP BY 1, 2, 3, 4""")
def pl15_idf(spark, sf_dir):
    return _job(spark, sf_dir, "IDF_Gold")


@proof("PL-15-idf-detail", _JOB + """SELECT "Quincena Evaluada", "Franquicia", coalesce("Solucion Aplicada", 'EN PROCESO / SIN SOLUCIÓN') AS "Solucion Aplicada",
  coalesce("Detalle Orden", 'SIN DETALLE REPORTADO') AS "Detalle Orden", count("N° Orden") AS "Total_Ordenes" FROM o WHERE "Es_Falla" = 1 GROUP BY 1, 2, 3, 4""")
def pl15_idf_detail(spark, sf_dir):
    return _job(spark, sf_dir, "IDF_Gold_Detalle_Solucion")


@proof("PL-15-stats", _JOB + """SELECT "Quincena Evaluada", "Franquicia", "Clasificacion", "SLA Resolucion Min", "SLA Despacho Min", "SLA Impresion Min"
  FROM o WHERE "SLA Resolucion Min" IS NOT NULL""")
def pl15_stats(spark, sf_dir):
    return _job(spark, sf_dir, "SLA_GOLD_STATS")


@proof("PL-15-fact", _JOB + """SELECT "Quincena Evaluada", "Franquicia", "Fecha Apertura Date", "Fecha Cierre Date", "N° Orden", "N° Contrato",
  coalesce("Solucion Aplicada", 'EN PROCESO / SIN SOLUCIÓN') AS "Solucion Aplicada", "Detalle Orden", "Clasificacion", "Grupo Afinidad", "SLA Resolucion Min",
  "SLA Despacho Min", "SLA Impresion Min", "Cumplio_SLA", "Duracion_Horas", "Es_Falla" FROM o""")
def pl15_fact(spark, sf_dir):
    return _job(spark, sf_dir, "Tickets_Fact_Gold")
