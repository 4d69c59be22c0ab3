"""Incremental merge, surrogate keys, validity intervals, unpivot and streaming proofs."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.core import c
from ..operators import keys as KY
from ..operators import merge as M
from ..plans import stock as ST
from ..session import Tables, checkpoint_root
from ..sources import partitioned as PT
from ..streaming import ingest as SI
from . import proof

Y1999, H1998 = dt.datetime(1999, 1, 1), dt.datetime(1998, 7, 1)


def _dated(o):
    return F.when(F.col("o_orderkey") % 50 == 0, F.lit(None).cast("date")).otherwise(F.to_date("o_orderdate"))


@proof("MRG-01", """WITH h AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fecha,
  o_orderstatus AS estado FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fecha, 'X' AS estado,
  o_totalprice AS monto FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01')
SELECT * FROM h WHERE fecha IS NOT NULL AND fecha NOT IN (SELECT fecha FROM b WHERE fecha IS NOT NULL)
UNION ALL BY NAME SELECT * FROM b WHERE fecha IS NOT NULL
UNION ALL BY NAME SELECT DISTINCT * FROM (SELECT * FROM h WHERE fecha IS NULL UNION ALL BY NAME SELECT * FROM b WHERE fecha IS NULL)""")
def mrg01(spark, d):
    o = Tables(spark, d).orders
    h = o.filter(F.col("o_orderdate") < F.lit(Y1999)).select("o_orderkey", _dated(o).alias("fecha"),
                                                             F.col("o_orderstatus").alias("estado"))
    b = o.filter(F.col("o_orderdate") >= F.lit(H1998)).select("o_orderkey", _dated(o).alias("fecha"), F.lit("X").alias("estado"),
                                                              F.col("o_totalprice").alias("monto"))
    return M.upsert_by_date(h, b, "fecha").select("o_orderkey", "fecha", "estado", "monto")


@proof("MRG-02", """SELECT DISTINCT * FROM (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01')""")
def mrg02(spark, d):
    o = Tables(spark, d).orders
    h = o.filter(F.col("o_orderdate") < F.lit(Y1999)).select("o_custkey", "o_orderstatus")
    b = o.filter(F.col("o_orderdate") >= F.lit(H1998)).select("o_custkey", "o_orderstatus")
    return M.append_distinct(h, b)


@proof("MRG-03", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def mrg03(spark, d):
    return M.initial_load(Tables(spark, d).orders.select("o_custkey", "o_orderpriority"))


@proof("MRG-04", """SELECT o_orderkey, o_orderstatus, 'orders_a.xlsx' AS "Source.Name" FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL BY NAME SELECT o_orderkey, o_totalprice, 'orders_b.xlsx' AS "Source.Name" FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'""")
def mrg04(spark, d):
    o = Tables(spark, d).orders
    a = o.filter(F.col("o_orderdate") < F.lit(Y1999)).select("o_orderkey", "o_orderstatus", F.lit("orders_a.xlsx").alias("Source.Name"))
    b = o.filter(F.col("o_orderdate") >= F.lit(H1998)).select("o_orderkey", "o_totalprice", F.lit("orders_b.xlsx").alias("Source.Name"))
    return M.consolidate(a, b)


LABEL_SQL = ("['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SEP','OCT','NOV','DIC'][month(o_orderdate)] || ' ' || "
             "CAST(year(o_orderdate) AS VARCHAR) || ' ' || CASE WHEN day(o_orderdate) <= 15 THEN 'Q1' ELSE 'Q2' END")


def _label():
    return D.half_label(F.month("o_orderdate"), F.year("o_orderdate"), F.dayofmonth("o_orderdate"))


@proof("MRG-05", f"""WITH h AS (SELECT {LABEL_SQL} AS quincena, o_custkey AS id, o_orderstatus AS estado, o_orderdate AS fecha
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
b0 AS (SELECT {LABEL_SQL} AS quincena, o_custkey AS id, o_orderpriority AS estado, o_orderdate AS fecha
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01'),
b AS (SELECT quincena, id, estado, fecha FROM (SELECT *, row_number() OVER (PARTITION BY quincena, id ORDER BY fecha DESC NULLS LAST,
  quincena ASC NULLS FIRST, id ASC NULLS FIRST, estado ASC NULLS FIRST, fecha ASC NULLS FIRST) AS rn FROM b0) WHERE rn = 1)
SELECT * FROM h WHERE quincena NOT IN (SELECT quincena FROM b) UNION ALL SELECT * FROM b""")
def mrg05(spark, d):
    o = Tables(spark, d).orders
    h = o.filter(F.col("o_orderdate") < F.lit(Y1999)).select(_label().alias("quincena"), F.col("o_custkey").alias("id"),
                                                             F.col("o_orderstatus").alias("estado"), F.col("o_orderdate").alias("fecha"))
    b = o.filter(F.col("o_orderdate") >= F.lit(H1998)).select(_label().alias("quincena"), F.col("o_custkey").alias("id"),
                                                              F.col("o_orderpriority").alias("estado"), F.col("o_orderdate").alias("fecha"))
    return M.upsert_by_label(h, b, "quincena", "id", ["fecha"])


@proof("MRG-06", f"""WITH s AS (SELECT {LABEL_SQL} AS q, n_name AS franquicia, o_custkey, o_orderdate FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F')
SELECT q AS quincena_evaluada, franquicia, count(DISTINCT o_custkey) AS total_abonados, max(o_orderdate) AS fecha_corte FROM s GROUP BY 1, 2""")
def mrg06(spark, d):
    t = Tables(spark, d)
    silver = (t.orders.filter(F.col("o_orderstatus") == "F").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(_label().alias("Quincena Evaluada"), F.col("n_name").alias("Franquicia"),
                      F.col("o_custkey").alias("ID"), F.col("o_orderdate").alias("FechaFin")))
    g = ST.stock_gold(silver)
    return g.select(c("Quincena Evaluada").alias("quincena_evaluada"), c("Franquicia").alias("franquicia"),
                    c("Total_Abonados").alias("total_abonados"), c("Fecha_Corte").alias("fecha_corte"))


@proof("MRG-07", """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC NULLS LAST, user_id, event_type, event_id, value) AS rn FROM events) WHERE rn = 1""")
def mrg07(spark, d):
    e = Tables(spark, d).events.select("user_id", "event_type", "event_id", "value", "ts")
    return M.newest_version(e, ["user_id", "event_type"], mtime_col="ts")


@proof("KEY-01", """WITH dim AS (SELECT c_custkey, c_custkey + 100 AS sk FROM customer WHERE c_nationkey < 20)
SELECT o_orderkey, coalesce(dim.sk, -1) AS cliente_sk FROM orders LEFT JOIN dim ON o_custkey = dim.c_custkey""")
def key01(spark, d):
    t = Tables(spark, d)
    dim = t.customer.filter(F.col("c_nationkey") < 20).select("c_custkey", (F.col("c_custkey") + 100).alias("sk"))
    return KY.attach_sk(t.orders.select("o_orderkey", "o_custkey"), dim, "o_custkey", "c_custkey", "sk").select(
        "o_orderkey", F.col("sk").alias("cliente_sk"))


@proof("KEY-02", """WITH prev AS (SELECT c_name AS nk, c_custkey * 2 AS sk FROM customer WHERE c_acctbal > 0),
cur AS (SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_name END AS nk FROM customer),
m AS (SELECT max(sk) AS mx FROM prev)
SELECT cur.c_custkey, cur.nk, prev.sk AS cliente_sk FROM cur JOIN prev ON cur.nk = prev.nk
UNION ALL
SELECT c_custkey, nk, mx + row_number() OVER (ORDER BY nk) AS cliente_sk FROM cur, m
WHERE nk IS NOT NULL AND trim(nk) <> '' AND nk NOT IN (SELECT nk FROM prev)""")
def key02(spark, d):
    cu = Tables(spark, d).customer
    prev = cu.filter(F.col("c_acctbal") > 0).select(F.col("c_name").alias("nk"), (F.col("c_custkey") * 2).alias("cliente_sk"))
    cur = cu.select("c_custkey", F.when(F.col("c_custkey") % 97 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("nk"))
    return KY.assign_sk(cur, prev, "nk", "cliente_sk").select("c_custkey", "nk", "cliente_sk")


@proof("SCD-01", """SELECT user_id, event_type, event_id, ts AS fecha_inicio,
  lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS fecha_fin,
  CASE WHEN lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) IS NULL THEN 'ACTIVO' ELSE 'HISTÓRICO' END AS estado
FROM events""")
def scd01(spark, d):
    e = Tables(spark, d).events.select("user_id", "event_type", "event_id", "ts")
    v = KY.validity_intervals(e, ["user_id", "event_type"], "ts", "fecha_inicio", "fecha_fin", "estado", tie_break=["event_id"])
    return v.select("user_id", "event_type", "event_id", "fecha_inicio", "fecha_fin", "estado")


@proof("SCD-02", """WITH s AS (SELECT user_id, event_type, ts, event_id,
  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT * FROM s WHERE prev IS NULL OR prev <> event_type)
SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current FROM f""")
def scd02(spark, d):
    e = Tables(spark, d).events.select("user_id", "event_type", "ts", "event_id")
    v = KY.scd2(e, ["user_id"], "ts", ["event_type"], tie_break=["event_id"])
    return v.select("user_id", "event_type", "valid_from", "valid_to", "is_current")


UNP_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre",
             "Noviembre", "Diciembre"]


@proof("UNP-01", "WITH w AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'ACTIVO' WHEN 'O' THEN 'CORTADO' ELSE 'SUSPENDIDO' END AS estatus, "
       "year(o_orderdate) AS anio, " + ", ".join(
           f"count(*) FILTER (WHERE month(o_orderdate) = {i}) AS \"{n}\"" for i, n in enumerate(UNP_NAMES, 1)) +
       " FROM orders GROUP BY 1, 2), u AS (UNPIVOT w ON " + ", ".join(f'"{n}"' for n in UNP_NAMES) +
       """ INTO NAME mes_nombre VALUE cantidad)
SELECT estatus, CAST(anio AS INTEGER) AS anio, mes_nombre, CAST(cantidad AS BIGINT) AS cantidad,
  make_date(anio, list_position(['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SEPTIEMBRE','OCTUBRE','NOVIEMBRE','DICIEMBRE'],
  upper(mes_nombre)), 1) AS fecha
FROM u WHERE cantidad > 0 AND estatus IN ('ACTIVO', 'ANULADO', 'CORTADO')""")
def unp01(spark, d):
    o = Tables(spark, d).orders
    st = F.when(F.col("o_orderstatus") == "F", "ACTIVO").when(F.col("o_orderstatus") == "O", "CORTADO").otherwise("SUSPENDIDO")
    wide = (o.withColumn("mes", D.month_name_es(F.month("o_orderdate")))
            .groupBy(st.alias("ESTATUS"), F.year("o_orderdate").alias("anio"))
            .pivot("mes", UNP_NAMES).agg(F.count(F.lit(1))))
    long = KY.unpivot_months(wide, ["ESTATUS", "anio"], UNP_NAMES, F.col("anio"), month_out="mes_nombre", value_out="cantidad")
    return long.select(F.col("ESTATUS").alias("estatus"), F.col("Anio").alias("anio"), "mes_nombre", "cantidad", F.col("Fecha").alias("fecha"))


def _target(spark, name):
    """A new folder of the shared scratch space: (table, checkpoint)."""
    root = f"{checkpoint_root(spark).rstrip('/')}/strata-{name}-{uuid.uuid4().hex[:12]}"
    return f"{root}/table", f"{root}/checkpoint"


@proof("MRG-01-table", """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS fecha,
  o_orderstatus, o_totalprice, o_orderdate FROM orders),
h AS (SELECT o_orderkey, fecha, o_orderstatus AS estado FROM o WHERE o_orderdate < TIMESTAMP '1999-01-01'),
b AS (SELECT o_orderkey, fecha, 'X' AS estado, o_totalprice AS monto FROM o WHERE o_orderdate >= TIMESTAMP '1998-07-01')
SELECT * FROM h WHERE fecha IS NOT NULL AND fecha NOT IN (SELECT fecha FROM b WHERE fecha IS NOT NULL)
UNION ALL BY NAME SELECT * FROM b WHERE fecha IS NOT NULL
UNION ALL BY NAME SELECT DISTINCT * FROM (SELECT * FROM h WHERE fecha IS NULL UNION ALL BY NAME SELECT * FROM b WHERE fecha IS NULL)""")
def mrg01_table(spark, d):
    o = Tables(spark, d).orders
    path, _ = _target(spark, "mrg01")
    month = F.when(F.col("o_orderkey") % 50 != 0, F.date_trunc("month", "o_orderdate").cast("date"))
    base = o.select("o_orderkey", month.alias("fecha"), F.col("o_orderstatus").alias("estado"), F.col("o_totalprice").alias("monto"), "o_orderdate")
    PT.replace_keys(spark, path, base.filter(F.col("o_orderdate") < F.lit(Y1999)).select("o_orderkey", "fecha", "estado"), "fecha")
    PT.replace_keys(spark, path, base.filter(F.col("o_orderdate") >= F.lit(H1998)).select("o_orderkey", "fecha", F.lit("X").alias("estado"), "monto"), "fecha")
    return PT.read_table(spark, path).select("o_orderkey", "fecha", "estado", "monto")


@proof("MRG-02-table", """SELECT DISTINCT * FROM (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01')""")
def mrg02_table(spark, d):
    o = Tables(spark, d).orders
    path, _ = _target(spark, "mrg02")
    for part in (F.col("o_orderdate") < F.lit(Y1999), F.col("o_orderdate") >= F.lit(H1998)):
        PT.append_new_rows(spark, path, o.filter(part).select("o_custkey", "o_orderstatus"), buckets=8)
    return PT.read_table(spark, path)


def _events_stream(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return SI.file_stream(spark, d, schema, glob="events.parquet")


@proof("STR-01", "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS dia FROM events")
def str01(spark, d):
    path, ckpt = _target(spark, "str01")
    s = _events_stream(spark, d).withColumn("dia", F.to_date("ts"))
    SI.run_available_now(s, SI.replace_dates(path, "dia"), ckpt)
    return PT.read_table(spark, path).select("event_id", "user_id", "event_type", "value", "dia")


@proof("STR-02", """SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC, event_id, value) AS rn FROM events) WHERE rn = 1""")
def str02(spark, d):
    path, ckpt = _target(spark, "str02")
    s = _events_stream(spark, d).select("user_id", "event_type", "event_id", "ts", "value")
    SI.keep_latest_stream(s, ["user_id", "event_type"], ["ts"], path, ckpt)
    return SI.read_latest(spark, path, ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "ts")
