"""Projection, filter, join, aggregate, window, sort and set proofs on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import dates as D
from ..functions.core import c
from ..operators import aggregates as A
from ..operators import filters as FL
from ..operators import joins as J
from ..operators import ordering as O
from ..operators import sets as S
from ..operators import shape as P
from ..operators import windows as W
from ..operators.rules import Rule, classify
from ..session import Tables
from ..operators.joins import attach_scalar
from . import proof
from .tickets import TICKETS_CTE, silver_slice, ticket_rows, OPEN_FROM, CLOSE_FROM, PERIOD_END

# ---------------------------------------------------------------- projection


@proof("PRJ-01", 'SELECT c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", c_mktsegment AS "C_MKTSEGMENT" FROM customer')
def prj01(spark, d):
    cu = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment")
    padded = cu.toDF(*[f"  {n} " for n in cu.columns])
    return P.clean_headers(padded, "upper")


@proof("PRJ-02", 'SELECT o_orderkey AS "ID", o_orderstatus AS "Estatus", o_totalprice FROM orders')
def prj02(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return P.rename_synonyms(o, {"ID": ["Id", "ID_CLIENTE", "o_orderkey"],
                                 "Estatus": ["Estatus contrato", "o_orderstatus"]}).select("ID", "Estatus", "o_totalprice")


@proof("PRJ-03", "SELECT c_custkey, c_name FROM customer")
def prj03(spark, d):
    cu = Tables(spark, d).customer
    dup = cu.select("c_custkey", "c_name", F.col("c_acctbal").cast("string").alias("c_name"))
    return P.dedupe_columns(dup)


@proof("PRJ-04", "SELECT p_partkey, p_name FROM part")
def prj04(spark, d):
    p = Tables(spark, d).part.select("p_partkey", F.lit(None).cast("string").alias("Unnamed: 1"), "p_name",
                                     F.col("p_type").alias("Col_3"))
    return P.drop_unnamed(p)


@proof("PRJ-05", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS extra_null, c_acctbal FROM customer")
def prj05(spark, d):
    contract = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType()),
                           StructField("extra_null", StringType()), StructField("c_acctbal", DoubleType())])
    return P.conform(Tables(spark, d).customer, contract)


@proof("PRJ-06", "SELECT o_orderkey, 'ORDERS' AS origen FROM orders")
def prj06(spark, d):
    return P.tag(Tables(spark, d).orders.select("o_orderkey"), "origen", "ORDERS")


@proof("PRJ-07", "SELECT * EXCLUDE (p_retailprice, p_size) FROM part")
def prj07(spark, d):
    return P.exclude(Tables(spark, d).part, "p_retailprice", "p_size")


@proof("PRJ-08", """SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'BAJO' WHEN o_totalprice < 300000 THEN 'MEDIO'
  ELSE 'ALTO' END AS rango FROM orders""")
def prj08(spark, d):
    x = F.col("o_totalprice")
    rules = [Rule(None, "expr", label="BAJO", predicate=x < 100000), Rule(None, "expr", label="MEDIO", predicate=x < 300000)]
    return Tables(spark, d).orders.select("o_orderkey", classify(rules, "ALTO").alias("rango"))


# ---------------------------------------------------------------- filters


@proof("FLT-01", """SELECT o_orderkey, cliente FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END
  AS cliente FROM orders) WHERE cliente IS NOT NULL""")
def flt01(spark, d):
    o = Tables(spark, d).orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("cliente"))
    return FL.not_null(o, "cliente")


@proof("FLT-02", """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders)
SELECT o_orderkey, p, coalesce(p IN ('1-URGENT', '2-HIGH'), false) AS urgente,
  coalesce(p NOT IN ('5-LOW'), false) AS no_baja, (p IS NULL OR p NOT IN ('5-LOW')) AS no_baja_con_nulos FROM s""")
def flt02(spark, d):
    o = Tables(spark, d).orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("p"))
    return o.select("o_orderkey", "p", FL.in_list("p", ["1-URGENT", "2-HIGH"]).alias("urgente"),
                    FL.in_list("p", ["5-LOW"], negate=True).alias("no_baja"),
                    FL.in_list("p", ["5-LOW"], negate=True, keep_null=True).alias("no_baja_con_nulos"))


@proof("FLT-03", """SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)(ring|BOLT)')
  AND NOT regexp_matches(p_name, '(?i)red')""")
def flt03(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name")
    return p.filter(FL.matches("p_name", "(ring|BOLT)") & FL.matches("p_name", "red", negate=True))


@proof("FLT-04", "SELECT p_partkey, p_type FROM part WHERE p_type NOT LIKE 'PROMO%'")
def flt04(spark, d):
    return Tables(spark, d).part.select("p_partkey", "p_type").filter(FL.not_like_prefix("p_type", "PROMO"))


@proof("FLT-05", """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
  AND o_orderdate <= TIMESTAMP '2001-12-31' AND o_orderdate < TIMESTAMP '2000-07-02'""")
def flt05(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return o.filter(FL.date_window("o_orderdate", dt.datetime(1996, 1, 1), dt.datetime(2001, 12, 31),
                                   as_of=dt.date(2000, 6, 30), future_days=1))


@proof("FLT-06", TICKETS_CTE + "SELECT ticket AS n_orden, opened AS fecha_apertura, closed AS fecha_cierre FROM f")
def flt06(spark, d):
    t = ticket_rows(Tables(spark, d))
    f = t.filter(FL.period_with_backlog(c("Fecha Apertura"), c("Fecha Cierre"), F.lit(OPEN_FROM), F.lit(PERIOD_END),
                                        F.lit(CLOSE_FROM)))
    return f.select(c("N° Orden").alias("n_orden"), c("Fecha Apertura").alias("fecha_apertura"),
                    c("Fecha Cierre").alias("fecha_cierre"))


@proof("FLT-07", """WITH s AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN ' ' || c_mktsegment || ' '
  ELSE c_mktsegment END AS seg FROM customer) SELECT c_custkey, seg FROM s WHERE upper(trim(seg)) = 'BUILDING'""")
def flt07(spark, d):
    k = F.col("c_custkey") % 3
    seg = (F.when(k == 0, F.lower("c_mktsegment")).when(k == 1, F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")))
           .otherwise(F.col("c_mktsegment")))
    cu = Tables(spark, d).customer.select("c_custkey", seg.alias("seg"))
    return cu.filter(FL.equals_normalized("seg", " building "))


@proof("FLT-08", """SELECT o_custkey, count(*) AS n FROM orders o JOIN customer cu ON cu.c_custkey = o.o_custkey
  WHERE length(cu.c_mktsegment) > 2 GROUP BY o_custkey HAVING count(*) >= 15""")
def flt08(spark, d):
    t = Tables(spark, d)
    cu = t.customer.filter(FL.min_length("c_mktsegment", 2)).select("c_custkey")
    g = t.orders.join(cu, F.col("o_custkey") == F.col("c_custkey")).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return g.filter(F.col("n") >= 15)


FEED_RULES = [
    {"type": "error", "response": "ALTO", "feed": "RECLAMOS_CRITICOS"},
    {"type": "error", "feed": "RECLAMOS"},
    {"type": ["click", "view"], "feed": "ATENCION"},
    {"response": "ALTO", "feed": "COBRANZA"},
]


@proof("FLT-09", """WITH s AS (SELECT event_id, event_type, CASE WHEN value >= 10 THEN 'ALTO' ELSE 'BAJO' END AS resp FROM events)
SELECT event_id, CASE WHEN upper(trim(event_type)) = 'ERROR' AND resp = 'ALTO' THEN 'RECLAMOS_CRITICOS'
  WHEN upper(trim(event_type)) = 'ERROR' THEN 'RECLAMOS' WHEN upper(trim(event_type)) IN ('CLICK', 'VIEW') THEN 'ATENCION'
  WHEN resp = 'ALTO' THEN 'COBRANZA' END AS feed FROM s""")
def flt09(spark, d):
    e = Tables(spark, d).events.select(
        "event_id", "event_type", F.when(F.col("value") >= 10, "ALTO").otherwise("BAJO").alias("resp"),
        F.lit(None).cast("string").alias("detalle"))
    return FL.route_feeds(e, FEED_RULES, "event_type", "resp", "detalle").select("event_id", "feed")


@proof("FLT-10", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')")
def flt10(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_orderstatus").filter(FL.in_list("o_orderstatus", ["F", "O"]))


# ---------------------------------------------------------------- joins


@proof("JON-01", """WITH r AS (SELECT trim(CAST(l_orderkey AS VARCHAR)) AS k, max(l_shipdate) AS ultima_entrega, count(*) AS n_lineas
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, ultima_entrega, n_lineas FROM orders LEFT JOIN r ON trim(CAST(o_orderkey AS VARCHAR)) = r.k""")
def jon01(spark, d):
    t = Tables(spark, d)
    norm = lambda x: F.trim(x.cast("string"))
    out = J.left_latest(t.orders.select("o_orderkey"), t.lineitem, "o_orderkey", "l_orderkey",
                        {"ultima_entrega": F.max("l_shipdate"), "n_lineas": F.count(F.lit(1))}, norm=norm)
    return out


@proof("JON-02", """WITH dim AS (SELECT c_custkey, c_custkey * 10 + 1 AS sk FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT o_orderkey, coalesce(dim.sk, -1) AS cliente_sk FROM orders LEFT JOIN dim ON o_custkey = dim.c_custkey""")
def jon02(spark, d):
    t = Tables(spark, d)
    dim = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", (F.col("c_custkey") * 10 + 1).alias("sk"))
    out = J.attach_sk(t.orders.select("o_orderkey", "o_custkey"), dim, "o_custkey", "c_custkey", "sk")
    return out.select("o_orderkey", F.col("sk").alias("cliente_sk"))


@proof("JON-03", """WITH prev AS (SELECT c_custkey AS k, c_custkey + 5000 AS sk_prev FROM customer WHERE c_acctbal > 0)
SELECT c_custkey, sk_prev FROM customer LEFT JOIN prev ON c_custkey = prev.k""")
def jon03(spark, d):
    cu = Tables(spark, d).customer
    prev = cu.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("k"), (F.col("c_custkey") + 5000).alias("sk_prev"))
    return cu.select("c_custkey").join(prev, F.col("c_custkey") == F.col("k"), "left").select("c_custkey", "sk_prev")


MAP_SQL = """WITH m AS (SELECT upper(trim(n_name)) AS k, max(lower(n_name)) AS nombre, max('REGION_' || CAST(n_regionkey AS VARCHAR)) AS estado,
  max('SEDE') AS tipo FROM nation WHERE n_regionkey <> 4 GROUP BY 1),
s AS (SELECT s_suppkey, n_name AS oficina FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""


@proof("JON-04", MAP_SQL + """SELECT s_suppkey, oficina, CASE WHEN m.k IS NOT NULL THEN m.nombre ELSE oficina END AS nombre_normalizado,
  CASE WHEN m.k IS NOT NULL THEN m.estado ELSE 'Sin Asignar' END AS estado_sede,
  CASE WHEN m.k IS NOT NULL THEN m.tipo ELSE 'Sin Asignar' END AS tipo_sede
FROM s LEFT JOIN m ON upper(trim(oficina)) = m.k""")
def jon04(spark, d):
    t = Tables(spark, d)
    mapping = t.nation.filter(F.col("n_regionkey") != 4).select(
        F.col("n_name").alias("Input_Original"), F.lower("n_name").alias("Nombre_Normalizado_Final"),
        F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")).alias("Estado"), F.lit("SEDE").alias("Tipo_Sede"))
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("oficina"))
    out = J.map_enrich(s, mapping, "oficina", "Input_Original",
                       {"Nombre_Normalizado_Final": "nombre_normalizado", "Estado": "estado_sede", "Tipo_Sede": "tipo_sede"},
                       fallback_col="nombre_normalizado")
    return out


@proof("JON-05", """SELECT l_orderkey, l_linenumber, o_custkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def jon05(spark, d):
    t = Tables(spark, d)
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
            .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "l_linenumber", "o_custkey", "l_quantity"))


@proof("JON-06", """WITH r AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT o_orderkey, l_orderkey, CASE WHEN o_orderkey IS NOT NULL AND l_orderkey IS NOT NULL THEN 'both'
  WHEN o_orderkey IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS merge
FROM orders FULL OUTER JOIN r ON o_orderkey = l_orderkey""")
def jon06(spark, d):
    t = Tables(spark, d)
    r = t.lineitem.select("l_orderkey").distinct()
    out = J.outer_with_indicator(t.orders.select("o_orderkey"), r, "o_orderkey", "l_orderkey", "merge")
    return out.select("o_orderkey", "l_orderkey", "merge")


@proof("JON-07", """WITH rep AS (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 12)
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM rep)""")
def jon07(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey")
    rep = o.groupBy("o_custkey").count().filter(F.col("count") > 12).select(F.col("o_custkey").alias("k"))
    return o.join(rep, F.col("o_custkey") == F.col("k"), "left_semi")


JOURNEY_SQL = """WITH fa2 AS (SELECT o_custkey, o_orderpriority, min(struct_pack(d := o_orderdate, k := o_orderkey)) AS first_seen FROM orders GROUP BY 1, 2),
j AS (SELECT o_custkey, string_agg(o_orderpriority, ' ➔ ' ORDER BY first_seen) AS recorrido FROM fa2 GROUP BY 1)
"""


@proof("JON-08", JOURNEY_SQL + "SELECT o.o_orderkey, o.o_custkey, j.recorrido FROM orders o LEFT JOIN j ON o.o_custkey = j.o_custkey")
def jon08(spark, d):
    o = Tables(spark, d).orders
    per = A.first_appearance_concat(o, ["o_custkey"], "o_orderpriority", ["o_orderdate", "o_orderkey"], " ➔ ", "recorrido")
    return o.select("o_orderkey", "o_custkey").join(per, "o_custkey", "left").select("o_orderkey", "o_custkey", "recorrido")


@proof("JON-09", """SELECT o_orderkey, o_orderdate FROM orders o WHERE NOT EXISTS
  (SELECT 1 FROM lineitem l WHERE CAST(l.l_shipdate AS DATE) = CAST(o.o_orderdate AS DATE))""")
def jon09(spark, d):
    t = Tables(spark, d)
    dates = t.lineitem.select(F.to_date("l_shipdate").alias("__d")).distinct()
    o = t.orders.select("o_orderkey", "o_orderdate")
    return o.join(dates, F.to_date("o_orderdate") == F.col("__d"), "left_anti")


# ---------------------------------------------------------------- aggregates


@proof("AGG-01", """WITH s AS (SELECT l_orderkey, CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_returnflag END AS flag, l_linestatus,
  l_quantity, l_extendedprice FROM lineitem)
SELECT flag, l_linestatus, count(DISTINCT l_orderkey) AS n_ordenes, round(sum(l_quantity), 2) AS sum_qty,
  round(sum(l_extendedprice), 2) AS sum_price FROM s WHERE flag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2""")
def agg01(spark, d):
    li = Tables(spark, d).lineitem.select(
        "l_orderkey", F.when(F.col("l_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"),
        "l_linestatus", "l_quantity", "l_extendedprice")
    return li.dropna(subset=["flag", "l_linestatus"]).groupBy("flag", "l_linestatus").agg(
        F.count_distinct("l_orderkey").alias("n_ordenes"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"))


@proof("AGG-02", """SELECT CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE month(o_orderdate) END AS INTEGER) AS mes,
  count(DISTINCT o_custkey) AS clientes FROM orders GROUP BY 1""")
def agg02(spark, d):
    o = Tables(spark, d).orders
    mes = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.month("o_orderdate"))
    return o.groupBy(mes.alias("mes")).agg(F.count_distinct("o_custkey").alias("clientes"))


@proof("AGG-03", """WITH s AS (SELECT CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS p,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS cli FROM orders)
SELECT coalesce(p, 'SIN DATO') AS prioridad, count(cli) AS n FROM s GROUP BY 1""")
def agg03(spark, d):
    o = Tables(spark, d).orders.select(
        F.when(F.col("o_orderkey") % 6 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("prioridad"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("cli"))
    return o.fillna({"prioridad": "SIN DATO"}).groupBy("prioridad").agg(F.count("cli").alias("n"))


@proof("AGG-04", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, n_name AS franquicia,
  count(DISTINCT o_custkey) AS abonados, max(o_orderdate) AS fecha_corte
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def agg04(spark, d):
    t = Tables(spark, d)
    j = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return j.groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("mes"), F.col("n_name").alias("franquicia")).agg(
        F.count_distinct("o_custkey").alias("abonados"), F.max("o_orderdate").alias("fecha_corte"))


@proof("AGG-05", "SELECT l_orderkey, max(l_shipdate) AS ultima, max(l_quantity) AS max_qty FROM lineitem GROUP BY 1")
def agg05(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("ultima"),
                                                               F.max("l_quantity").alias("max_qty"))


@proof("AGG-06", """SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
  GROUP BY 1 ORDER BY 1""")
def agg06(spark, d):
    return (Tables(spark, d).orders.groupBy(F.year("o_orderdate").alias("anio"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).orderBy("anio"))


@proof("AGG-07", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def agg07(spark, d):
    return Tables(spark, d).events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@proof("AGG-08", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC")
def agg08(spark, d):
    return Tables(spark, d).events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc())


@proof("AGG-09", """WITH fa AS (SELECT user_id, event_type, min(struct_pack(t := ts, i := event_id)) AS first_seen FROM events GROUP BY 1, 2)
SELECT user_id, string_agg(event_type, '; ' ORDER BY first_seen) AS recorrido FROM fa GROUP BY 1""")
def agg09(spark, d):
    e = Tables(spark, d).events
    return A.first_appearance_concat(e, ["user_id"], "event_type", ["ts", "event_id"], "; ", "recorrido")


@proof("AGG-10", """SELECT user_id, string_agg(event_type, ' ➔ ' ORDER BY ts, event_id) AS viaje FROM events GROUP BY 1""")
def agg10(spark, d):
    e = Tables(spark, d).events
    return e.groupBy("user_id").agg(A.ordered_concat("event_type", ["ts", "event_id"], " ➔ ", distinct=False).alias("viaje"))


@proof("AGG-11", """SELECT o_custkey, round_even(avg(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END), 1) AS media
  FROM orders GROUP BY 1""")
def agg11(spark, d):
    o = Tables(spark, d).orders
    v = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_totalprice"))
    return o.groupBy("o_custkey").agg(D.round_half_even(F.avg(v), 1).alias("media"))


@proof("AGG-12", """SELECT l_returnflag, median(l_quantity) AS mediana_qty, round(avg(l_extendedprice), 4) AS media_precio
  FROM lineitem GROUP BY 1 ORDER BY mediana_qty DESC""")
def agg12(spark, d):
    return (Tables(spark, d).lineitem.groupBy("l_returnflag")
            .agg(F.median("l_quantity").alias("mediana_qty"), F.round(F.avg("l_extendedprice"), 4).alias("media_precio"))
            .orderBy(F.col("mediana_qty").desc()))


@proof("AGG-13", """SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, median(l_quantity) FILTER (WHERE l_linestatus = 'F') AS med_f,
  median(l_quantity) FILTER (WHERE l_linestatus = 'O') AS med_o FROM lineitem GROUP BY 1""")
def agg13(spark, d):
    li = Tables(spark, d).lineitem
    p = li.groupBy(F.year("l_shipdate").alias("anio")).pivot("l_linestatus", ["F", "O"]).agg(F.median("l_quantity"))
    return p.withColumnsRenamed({"F": "med_f", "O": "med_o"})


@proof("AGG-14", """WITH g AS (SELECT o_orderpriority, count(*) AS n, count_if(o_orderstatus = 'F') AS finales FROM orders GROUP BY 1)
SELECT o_orderpriority, n, round(100.0 * n / sum(n) OVER (), 4) AS pct_total, round(100.0 * finales / n, 4) AS tasa_final FROM g""")
def agg14(spark, d):
    g = Tables(spark, d).orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finales"))
    g = A.share_of_total(g, "n", "pct_total", scale=4)
    return g.select("o_orderpriority", "n", "pct_total", F.round(F.col("finales") * 100.0 / F.col("n"), 4).alias("tasa_final"))


@proof("AGG-15", "SELECT user_id, CAST(count_if(event_type = 'error') AS BIGINT) AS errores FROM events GROUP BY 1")
def agg15(spark, d):
    return Tables(spark, d).events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errores"))


# sketches are compared by their stated errors: ranks within 1 / 1000 of the rows, distinct counts within a tenth
AGG16_SQL = """SELECT 'o_totalprice' AS "column", count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std,
  min(o_totalprice) AS min, max(o_totalprice) AS max, true AS unique_ok, true AS q1_ok, true AS q2_ok, true AS q3_ok FROM orders
UNION ALL SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey), 4), round(stddev_samp(o_custkey), 4), min(o_custkey), max(o_custkey), true, true, true, true FROM orders
UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), NULL, NULL, NULL, NULL, true, true, true, true FROM orders"""


@proof("AGG-16", AGG16_SQL)
def agg16(spark, d):
    o = Tables(spark, d).orders
    cols = ["o_totalprice", "o_custkey", "o_orderstatus"]
    p = A.profile(o, cols)
    # the rows below and up to each quartile, and the distinct values, counted exactly
    wide = attach_scalar(o, p.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("column", "quartiles"))).alias("q")))
    ranks = wide.agg(*[F.count_if(F.col(n) < F.col("q")[n][i]).alias(f"below_{n}_{i}") for n in cols[:2] for i in range(3)],
                     *[F.count_if(F.col(n) <= F.col("q")[n][i]).alias(f"upto_{n}_{i}") for n in cols[:2] for i in range(3)],
                     *[F.count_distinct(n).alias(f"distinct_{n}") for n in cols])
    checked = attach_scalar(p, ranks)

    def within(i):
        want = F.col("count") * (i + 1) / 4
        slack = F.col("count") / 1000 + 1
        ok = [(F.col("column") == n) & (F.col(f"below_{n}_{i}") <= want + slack) & (F.col(f"upto_{n}_{i}") >= want - slack) for n in cols[:2]]
        return (F.col("column") == cols[2]) | ok[0] | ok[1]

    near = [(F.col("column") == n) & (F.abs(F.col("unique") - F.col(f"distinct_{n}")) <= 0.1 * F.col(f"distinct_{n}")) for n in cols]
    return checked.select("column", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max",
                          (near[0] | near[1] | near[2]).alias("unique_ok"), *[within(i).alias(f"q{i + 1}_ok") for i in range(3)])


@proof("AGG-17", """SELECT round(avg(l_orderkey), 4) AS avg_l_orderkey, round(avg(l_partkey), 4) AS avg_l_partkey,
  round(avg(l_suppkey), 4) AS avg_l_suppkey, round(avg(l_linenumber), 4) AS avg_l_linenumber, round(avg(l_quantity), 4) AS avg_l_quantity,
  round(avg(l_extendedprice), 4) AS avg_l_extendedprice, round(avg(l_discount), 4) AS avg_l_discount, round(avg(l_tax), 4) AS avg_l_tax
  FROM lineitem WHERE l_returnflag = 'R'""")
def agg17(spark, d):
    return A.numeric_means(Tables(spark, d).lineitem.filter(F.col("l_returnflag") == "R"), scale=4)


@proof("AGG-18", """SELECT CAST(floor(o_totalprice / 50000) * 50000 AS BIGINT) AS bin_start, count(*) AS n,
  CAST(CAST(floor(o_totalprice / 50000) * 50000 AS BIGINT) AS VARCHAR) || ' a ' || CAST(CAST(floor(o_totalprice / 50000) * 50000 AS BIGINT) + 49999 AS VARCHAR) AS bin
  FROM orders GROUP BY 1""")
def agg18(spark, d):
    return A.fixed_width_histogram(Tables(spark, d).orders, "o_totalprice", 50000)


@proof("AGG-19", """WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT l_extendedprice AS x, CASE WHEN hi = lo THEN 1 ELSE least(floor((l_extendedprice - lo) / (hi - lo) * 30) + 1, 30) END AS bucket
  FROM lineitem, mm)
SELECT CAST(bucket AS INTEGER) AS bucket, count(*) AS n, min(x) AS lo, max(x) AS hi FROM b GROUP BY 1""")
def agg19(spark, d):
    return A.equal_width_histogram(Tables(spark, d).lineitem, "l_extendedprice", 30)


@proof("AGG-20", "SELECT max(c_custkey) AS max_sk FROM customer")
def agg20(spark, d):
    return Tables(spark, d).customer.agg(F.max("c_custkey").alias("max_sk"))


@proof("AGG-21", """SELECT count(*) AS filas, count(DISTINCT l_orderkey) AS ordenes, CAST(count_if(l_linestatus = 'F') AS BIGINT) AS cerradas FROM lineitem""")
def agg21(spark, d):
    return Tables(spark, d).lineitem.agg(F.count(F.lit(1)).alias("filas"), F.count_distinct("l_orderkey").alias("ordenes"),
                                         F.count_if(F.col("l_linestatus") == "F").alias("cerradas"))


# ---------------------------------------------------------------- windows


@proof("WIN-01", """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def win01(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return W.keep_latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@proof("WIN-02", """SELECT o_custkey, o_orderkey, version FROM (SELECT o_custkey, o_orderkey, o_orderkey % 3 AS version,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 3 DESC NULLS LAST, o_orderdate DESC NULLS LAST, o_orderkey ASC) AS rn
  FROM orders) WHERE rn = 1""")
def win02(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate", (F.col("o_orderkey") % 3).alias("version"))
    return W.keep_latest(o, ["o_custkey"], ["version", "o_orderdate"], tie_break=[F.col("o_orderkey").asc()]).drop("o_orderdate")


@proof("WIN-03", """SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def win03(spark, d):
    e = Tables(spark, d).events.select("user_id", "event_type", "event_id", "ts")
    return W.keep_latest(e, ["user_id", "event_type"], ["ts", "event_id"])


@proof("WIN-04", """SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts ASC, event_id ASC) AS rn FROM events) WHERE rn = 1""")
def win04(spark, d):
    e = Tables(spark, d).events.select("user_id", "event_type", "event_id", "ts")
    return W.keep_first(e, ["user_id", "event_type"], [F.col("ts").asc(), F.col("event_id").asc()])


@proof("WIN-05", TICKETS_CTE + "SELECT ticket AS n_orden, closed AS fecha_cierre, printed AS fecha_impresion, solution AS solucion FROM silver")
def win05(spark, d):
    s = silver_slice(Tables(spark, d))
    return s.select(c("N° Orden").alias("n_orden"), c("Fecha Cierre").alias("fecha_cierre"),
                    c("Fecha Impresion").alias("fecha_impresion"), c("Solucion Aplicada").alias("solucion"))


@proof("WIN-06", """SELECT user_id, dia, event_id FROM (SELECT user_id, CAST(ts AS DATE) AS dia, event_id,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def win06(spark, d):
    e = Tables(spark, d).events.select("user_id", F.to_date("ts").alias("dia"), "event_id")
    return W.keep_latest(e, ["user_id", "dia"], ["event_id"])


@proof("WIN-07", """SELECT event_id, user_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS siguiente,
  round(date_diff('microsecond', ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1000000.0::DOUBLE, 3) AS gap_s
  FROM events""")
def win07(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    e = W.next_value(e, ["user_id"], ["ts", "event_id"], "ts", "siguiente", bucket=F.date_trunc("day", "ts"))
    return e.select("event_id", "user_id", "siguiente",
                    F.round(D.micros_between("siguiente", "ts") / F.lit(1000000.0), 3).alias("gap_s"))


@proof("WIN-08", "SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n_cliente FROM orders")
def win08(spark, d):
    return W.count_over(Tables(spark, d).orders.select("o_orderkey", "o_custkey"), ["o_custkey"], "n_cliente")


@proof("WIN-09", """WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '  ' WHEN p_partkey % 10 = 1 THEN NULL ELSE p_type END AS tipo FROM part),
k AS (SELECT nullif(trim(tipo), '') AS cat, count(*) AS n FROM s WHERE nullif(trim(tipo), '') IS NOT NULL GROUP BY 1),
r AS (SELECT cat, dense_rank() OVER (ORDER BY n DESC) AS rango FROM k)
SELECT p_partkey, tipo, CAST(coalesce(r.rango, 0) AS INTEGER) AS rango FROM s LEFT JOIN r ON nullif(trim(tipo), '') = r.cat""")
def win09(spark, d):
    k = F.col("p_partkey") % 10
    p = Tables(spark, d).part.select(
        "p_partkey", F.when(k == 0, F.lit("  ")).when(k == 1, F.lit(None)).otherwise(F.col("p_type")).alias("tipo"))
    return W.frequency_rank(p, "tipo", "rango")


PARETO_SQL = """WITH g AS (SELECT p_brand, sum(l_extendedprice * (1 - l_discount)) AS ingreso FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
r AS (SELECT p_brand, ingreso, 100.0 * sum(ingreso) OVER (ORDER BY ingreso DESC, p_brand ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  / sum(ingreso) OVER () AS acum FROM g)
"""


@proof("WIN-10", PARETO_SQL + """SELECT p_brand, round(ingreso, 2) AS ingreso, round(acum, 4) AS pct_acumulado,
  CASE WHEN acum <= 80 THEN 'A' ELSE 'B' END AS clase FROM r""")
def win10(spark, d):
    t = Tables(spark, d)
    g = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand")
         .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("ingreso")))
    r = W.running_share(g, "ingreso", [F.col("ingreso").desc(), F.col("p_brand").asc()], "acum")
    return r.select("p_brand", F.round("ingreso", 2).alias("ingreso"), F.round("acum", 4).alias("pct_acumulado"),
                    F.when(F.col("acum") <= 80, "A").otherwise("B").alias("clase"))


@proof("WIN-11", "SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS seq FROM customer")
def win11(spark, d):
    from ..operators.keys import global_sequence
    return global_sequence(Tables(spark, d).customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"], "seq").select(
        "c_custkey", "seq")


# ---------------------------------------------------------------- sort / top-k


@proof("SRT-01", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_totalprice ASC, o_orderkey")
def srt01(spark, d):
    return (Tables(spark, d).orders.select("o_orderkey", "o_orderdate", "o_totalprice")
            .orderBy(F.col("o_orderdate").desc(), "o_totalprice", "o_orderkey"))


@proof("SRT-02", """WITH s AS (SELECT ['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SEP','OCT','NOV','DIC'][month(o_orderdate)] || ' '
  || CAST(year(o_orderdate) AS VARCHAR) || ' ' || CASE WHEN day(o_orderdate) <= 15 THEN 'Q1' ELSE 'Q2' END AS quincena,
  CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-'
  || CASE WHEN day(o_orderdate) <= 15 THEN 'Q1' ELSE 'Q2' END AS orden FROM orders)
SELECT quincena, orden, count(*) AS n FROM s GROUP BY 1, 2 ORDER BY orden""")
def srt02(spark, d):
    o = Tables(spark, d).orders
    lab = D.half_label(F.month("o_orderdate"), F.year("o_orderdate"), F.dayofmonth("o_orderdate"))
    g = o.groupBy(lab.alias("quincena")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("quincena", D.period_sort_key("quincena").alias("orden"), "n").orderBy("orden")


@proof("TOP-01", """SELECT o_custkey, o_orderkey, CAST(rank AS INTEGER) AS rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""")
def top01(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return O.top_k_per_group(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 3).select(
        "o_custkey", "o_orderkey", "rank")


@proof("TOP-02", "SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL ORDER BY p_name LIMIT 15")
def top02(spark, d):
    return O.preview_values(Tables(spark, d).part, "p_name", 15)


@proof("TOP-03", """WITH g AS (SELECT p_brand, sum(l_extendedprice) AS m FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
t AS (SELECT p_brand FROM g ORDER BY m DESC, p_brand LIMIT 5)
SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IN (SELECT p_brand FROM t)""")
def top03(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_brand", "l_extendedprice")
    return O.top_n_filter(j, "p_brand", "l_extendedprice", 5).select("l_orderkey", "l_linenumber", "p_brand")


# ---------------------------------------------------------------- sets


@proof("SET-01", """SELECT c_custkey AS clave, c_name AS nombre, c_acctbal AS saldo, c_mktsegment AS segmento FROM customer
UNION ALL BY NAME SELECT s_suppkey AS clave, s_name AS nombre, s_acctbal AS saldo FROM supplier""")
def set01(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("clave"), F.col("c_name").alias("nombre"),
                          F.col("c_acctbal").alias("saldo"), F.col("c_mktsegment").alias("segmento"))
    b = t.supplier.select(F.col("s_suppkey").alias("clave"), F.col("s_name").alias("nombre"), F.col("s_acctbal").alias("saldo"))
    return S.union_all_by_name(a, b)


@proof("SET-02", """SELECT o_orderkey, CAST(CAST(trunc(o_totalprice) AS INTEGER) AS DOUBLE) AS monto FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def set02(spark, d):
    o = Tables(spark, d).orders
    a = o.filter(F.col("o_orderdate") < F.lit(dt.datetime(1998, 1, 1))).select(
        "o_orderkey", F.col("o_totalprice").cast("int").alias("monto"))
    b = o.filter(F.col("o_orderdate") >= F.lit(dt.datetime(1998, 1, 1))).select("o_orderkey", F.col("o_totalprice").alias("monto"))
    contract = StructType([StructField("o_orderkey", LongType()), StructField("monto", DoubleType())])
    return S.relaxed_union(contract, a, b)


@proof("SET-03", " UNION ALL ".join(
    f"SELECT {y} AS anio, count(*) AS n FROM orders WHERE year(o_orderdate) = {y}" for y in range(1995, 2002)))
def set03(spark, d):
    o = Tables(spark, d).orders
    parts = [o.filter(F.year("o_orderdate") == y).agg(F.lit(y).alias("anio"), F.count(F.lit(1)).alias("n"))
             for y in range(1995, 2002)]
    return S.union_all_by_name(*parts)


@proof("SET-04", """SELECT DISTINCT * FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')""")
def set04(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    a = o.filter(F.col("o_orderdate") < F.lit(dt.datetime(1999, 1, 1))).drop("o_orderdate")
    b = o.filter(F.col("o_orderdate") >= F.lit(dt.datetime(1998, 1, 1))).drop("o_orderdate")
    return S.union_distinct(a, b)


@proof("SET-05", "SELECT DISTINCT c_nationkey FROM customer")
def set05(spark, d):
    return S.distinct_values(Tables(spark, d).customer, "c_nationkey")


@proof("SET-06", """WITH n AS (SELECT n_nationkey, CASE WHEN n_nationkey = 24 THEN 'NO DEFINIDA' WHEN n_nationkey = 23 THEN ' ' ELSE n_name END AS nm FROM nation),
u AS (SELECT trim(nm) AS franquicia FROM customer JOIN n ON c_nationkey = n_nationkey
  UNION SELECT trim(nm) FROM supplier JOIN n ON s_nationkey = n_nationkey)
SELECT franquicia FROM u WHERE franquicia IS NOT NULL AND franquicia <> '' AND upper(franquicia) <> 'NO DEFINIDA' ORDER BY 1""")
def set06(spark, d):
    t = Tables(spark, d)
    n = t.nation.select("n_nationkey", F.when(F.col("n_nationkey") == 24, "NO DEFINIDA").when(F.col("n_nationkey") == 23, " ")
                        .otherwise(F.col("n_name")).alias("nm"))
    a = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    b = t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return S.value_set((a, "nm"), (b, "nm"), out="franquicia")
