"""Analytics (AN-*), statistics (ST-*), data quality (DQ-*), KPI and UDF-surface proofs."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.core import c
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import stats as STT
from ..plans import analytics as AN
from ..plans import tickets as T
from ..session import Tables, checkpoint_root
from ..sources.lake import audited_write
from . import proof
from .history import LABEL_SQL
from .tickets import TICKETS_CTE, silver_slice

K = AN.TicketCols(contract="contrato", cause="causa", opened="apertura", closed="cierre", solution="solucion",
                  group="grupo", period="quincena", period_key="orden_quincena", ticket="orden")
KEY_SQL = ("CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-' || "
           "CASE WHEN day(o_orderdate) <= 15 THEN 'Q1' ELSE 'Q2' END")

BASE_SQL = f"""WITH last AS (SELECT l_orderkey, max(l_shipdate) AS cierre FROM lineitem GROUP BY 1),
tk AS (SELECT o_orderkey AS orden, o_custkey AS contrato, o_orderpriority AS causa, o_orderdate AS apertura, last.cierre AS cierre,
  o_orderstatus AS solucion, 'G' || CAST(o_custkey % 7 AS VARCHAR) AS grupo, {LABEL_SQL} AS quincena, {KEY_SQL} AS orden_quincena
  FROM orders LEFT JOIN last ON o_orderkey = l_orderkey),
sv0 AS (SELECT *, lead(apertura) OVER (PARTITION BY contrato, causa ORDER BY apertura, orden) AS siguiente_apertura FROM tk),
sv AS (SELECT *, CASE WHEN siguiente_apertura IS NULL OR cierre IS NULL THEN NULL
  ELSE greatest(date_diff('microsecond', cierre, siguiente_apertura) / 86400000000.0::DOUBLE, 0.0) END AS supervivencia_dias FROM sv0),
fd AS (SELECT orden_quincena, quincena, contrato, causa, CAST(CAST(apertura AS DATE) AS VARCHAR) AS v, min(struct_pack(a := apertura, o := orden)) AS fs
  FROM sv GROUP BY 1, 2, 3, 4, 5),
fs AS (SELECT orden_quincena, quincena, contrato, causa, solucion AS v, min(struct_pack(a := apertura, o := orden)) AS fs
  FROM sv GROUP BY 1, 2, 3, 4, 5),
grp AS (SELECT g.*, (SELECT string_agg(v, '; ' ORDER BY fs) FROM fd WHERE fd.orden_quincena = g.orden_quincena AND fd.contrato = g.contrato
    AND fd.causa = g.causa) AS fechas_atendidas,
  (SELECT string_agg(v, '; ' ORDER BY fs) FROM fs WHERE fs.orden_quincena = g.orden_quincena AND fs.contrato = g.contrato
    AND fs.causa = g.causa) AS soluciones
  FROM (SELECT orden_quincena, quincena, contrato, causa, count(*) AS repeticiones,
    round_even(avg(supervivencia_dias), 1) AS promedio_supervivencia_dias FROM sv GROUP BY 1, 2, 3, 4 HAVING count(*) > 1) g),
fj AS (SELECT orden_quincena, quincena, contrato, solucion AS v, min(struct_pack(a := apertura, o := orden)) AS fs FROM sv GROUP BY 1, 2, 3, 4),
fr AS (SELECT g.*, (SELECT string_agg(v, ' ➔ ' ORDER BY fs) FROM fj WHERE fj.orden_quincena = g.orden_quincena AND fj.contrato = g.contrato)
    AS viaje_soluciones
  FROM (SELECT orden_quincena, quincena, contrato, count(*) AS total_tickets, count(DISTINCT causa) AS cantidad_causas_distintas,
    count(DISTINCT solucion) AS cantidad_soluciones_distintas FROM sv GROUP BY 1, 2, 3 HAVING count(*) > 1) g)
"""


def order_tickets(t: Tables):
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("cierre"))
    o = t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    q = D.half_label(F.month("o_orderdate"), F.year("o_orderdate"), F.dayofmonth("o_orderdate"))
    return o.select(F.col("o_orderkey").alias("orden"), F.col("o_custkey").alias("contrato"),
                    F.col("o_orderpriority").alias("causa"), F.col("o_orderdate").alias("apertura"), "cierre",
                    F.col("o_orderstatus").alias("solucion"),
                    F.concat(F.lit("G"), (F.col("o_custkey") % 7).cast("string")).alias("grupo"),
                    q.alias("quincena"),
                    F.concat_ws("-", F.year("o_orderdate").cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"),
                                F.when(F.dayofmonth("o_orderdate") <= 15, "Q1").otherwise("Q2")).alias("orden_quincena"))


def _lower(df):
    return df.toDF(*[n.lower() for n in df.columns])


@proof("AN-01", BASE_SQL + "SELECT orden, siguiente_apertura, supervivencia_dias FROM sv")
def an01(spark, d):
    return AN.survival(order_tickets(Tables(spark, d)), K).select(
        "orden", F.col("Siguiente_Apertura").alias("siguiente_apertura"), F.col("Supervivencia_Dias").alias("supervivencia_dias"))


def _groups(spark, d):
    return AN.recurrence_groups(AN.survival(order_tickets(Tables(spark, d)), K), K)


@proof("AN-02", BASE_SQL + "SELECT * FROM grp")
def an02(spark, d):
    return _lower(_groups(spark, d))


@proof("AN-03", BASE_SQL + """, pr AS (SELECT causa, count(DISTINCT contrato) AS casos_afectados, CAST(sum(repeticiones) AS BIGINT) AS total_tickets_involucrados,
  round_even(avg(promedio_supervivencia_dias), 1) AS supervivencia_promedio_dias FROM grp GROUP BY 1),
sh AS (SELECT *, total_tickets_involucrados / sum(total_tickets_involucrados) OVER () * 100 AS s FROM pr)
SELECT causa, casos_afectados, total_tickets_involucrados, supervivencia_promedio_dias, round_even(s, 2) AS pct_del_total,
  round_even(sum(s) OVER (ORDER BY total_tickets_involucrados DESC, causa ASC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
  AS pct_acumulado_pareto FROM sh""")
def an03(spark, d):
    return _lower(AN.pareto_by_cause(_groups(spark, d), K))


@proof("AN-04", BASE_SQL + """SELECT orden_quincena, quincena, count(DISTINCT contrato) AS casos_afectados,
  CAST(sum(repeticiones) AS BIGINT) AS total_tickets_involucrados, round_even(avg(promedio_supervivencia_dias), 1) AS supervivencia_promedio_dias
  FROM grp GROUP BY 1, 2 ORDER BY 1""")
def an04(spark, d):
    return _lower(AN.evolution(_groups(spark, d), K))


def _friction(spark, d):
    return AN.friction(order_tickets(Tables(spark, d)), K)


@proof("AN-05", BASE_SQL + "SELECT * FROM fr")
def an05(spark, d):
    return _lower(_friction(spark, d))


@proof("AN-05-causes", BASE_SQL + """SELECT orden_quincena, quincena, contrato, count(*) AS total_tickets,
  coalesce(string_agg(causa, ' ➔ ' ORDER BY apertura, orden), '') AS viaje_fallas, count(DISTINCT causa) AS cantidad_causas_distintas
  FROM sv GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def an05_causes(spark, d):
    return _lower(AN.cause_journey(order_tickets(Tables(spark, d)), K))


@proof("AN-06", BASE_SQL + """SELECT viaje_soluciones, count(DISTINCT contrato) AS casos_afectados, CAST(sum(total_tickets) AS BIGINT) AS total_tickets_involucrados
  FROM fr GROUP BY 1 ORDER BY 2 DESC, 1""")
def an06(spark, d):
    return _lower(AN.journey_ranking(_friction(spark, d), K))


@proof("AN-07", BASE_SQL + """, fq AS (SELECT contrato, quincena, min(orden_quincena) AS k FROM fr GROUP BY 1, 2)
SELECT f.contrato, string_agg(viaje_soluciones, ' || ' ORDER BY orden_quincena, quincena) AS viaje_soluciones_completo,
  CAST(sum(total_tickets) AS BIGINT) AS total_tickets_periodo,
  (SELECT string_agg(quincena, ', ' ORDER BY k, quincena) FROM fq WHERE fq.contrato = f.contrato) AS quincenas_afectadas
FROM fr f GROUP BY 1 ORDER BY 3 DESC, 1""")
def an07(spark, d):
    return _lower(AN.lifetime_journey(_friction(spark, d), K))


@proof("AN-08", BASE_SQL + """SELECT grupo, count(orden) AS total_tickets_atendidos, CAST(count_if(siguiente_apertura IS NOT NULL) AS BIGINT) AS tickets_reincidentes,
  round_even(avg(supervivencia_dias), 2) AS dias_prom_reincidencia,
  round_even(count_if(siguiente_apertura IS NOT NULL) / count(orden) * 100, 2) AS tasa_reincidencia_pct
FROM sv GROUP BY 1 HAVING count(orden) >= 20 ORDER BY 3 DESC, 1""")
def an08(spark, d):
    return _lower(AN.repeat_rate(AN.survival(order_tickets(Tables(spark, d)), K), K))


@proof("AN-09", BASE_SQL + """SELECT orden, contrato, apertura FROM tk WHERE contrato IN (SELECT contrato FROM fr)
  ORDER BY contrato, apertura, orden""")
def an09(spark, d):
    tk = order_tickets(Tables(spark, d))
    return AN.case_file(tk, AN.friction(tk, K), K).select("orden", "contrato", "apertura")


@proof("AN-10", """WITH last AS (SELECT l_orderkey, max(l_shipdate) AS cierre FROM lineitem GROUP BY 1),
s AS (SELECT o_orderkey, o_orderdate, last.cierre, CASE o_orderstatus WHEN 'F' THEN 'ACTIVO' WHEN 'O' THEN 'REEMBOLSO PARCIAL'
  ELSE 'CORTADO' END AS estatus FROM orders LEFT JOIN last ON o_orderkey = l_orderkey),
g AS (SELECT o_orderkey, estatus, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(cierre AS DATE)) AS INTEGER) AS dias FROM s)
SELECT o_orderkey, dias, CASE WHEN dias >= 30 AND dias < 60 THEN 30 WHEN dias >= 60 AND dias < 120 THEN 60 WHEN dias >= 120 THEN 120
  ELSE 0 END AS marca_clase FROM g WHERE estatus <> 'ACTIVO' AND NOT starts_with(estatus, 'REEMBOLSO') ORDER BY dias DESC NULLS LAST""")
def an10(spark, d):
    t = Tables(spark, d)
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("cierre"))
    st = (F.when(F.col("o_orderstatus") == "F", "ACTIVO").when(F.col("o_orderstatus") == "O", "REEMBOLSO PARCIAL")
          .otherwise("CORTADO"))
    s = t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "o_orderdate", "cierre",
                                                                                       st.alias("estatus"))
    return AN.early_churn(s, "cierre", "o_orderdate", "estatus", exclude_prefix="REEMBOLSO").select("o_orderkey", "dias", "marca_clase")


@proof("AN-11", """WITH j AS (SELECT p_brand, CASE WHEN l_shipdate IS NULL OR o_orderdate IS NULL THEN NULL
    ELSE greatest(round_even(date_diff('microsecond', o_orderdate, l_shipdate) / 60000000.0::DOUBLE, 2), 0.0) END AS minutos
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
t AS (SELECT p_brand FROM j GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 5),
h AS (SELECT CAST(floor(minutos / 43200) * 43200 AS BIGINT) AS bin_start FROM j WHERE p_brand IN (SELECT p_brand FROM t) AND minutos IS NOT NULL)
SELECT bin_start, count(*) AS n, CAST(bin_start AS VARCHAR) || ' a ' || CAST(bin_start + 43199 AS VARCHAR) AS bin FROM h GROUP BY 1""")
def an11(spark, d):
    t = Tables(spark, d)
    j = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .select("p_brand", D.minutes_between("l_shipdate", "o_orderdate").alias("minutos")))
    return AN.top_solutions_histogram(j, "p_brand", "minutos", 5, 43200.0)


@proof("AN-12", """WITH a AS (SELECT o_orderstatus, count(*) AS v FROM orders GROUP BY 1),
b AS (SELECT o_orderstatus, count(*) AS v FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1),
c AS (SELECT o_orderstatus, count(*) AS v FROM orders WHERE year(o_orderdate) > 1995 GROUP BY 1)
SELECT coalesce(a.o_orderstatus, b.o_orderstatus, c.o_orderstatus) AS o_orderstatus, a.v AS recaudacion, b.v AS ventas, c.v AS atencion
FROM a FULL OUTER JOIN b ON a.o_orderstatus = b.o_orderstatus FULL OUTER JOIN c ON coalesce(a.o_orderstatus, b.o_orderstatus) = c.o_orderstatus""")
def an12(spark, d):
    t = Tables(spark, d)
    o = t.orders
    a = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("v"))
    b = (o.join(t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
         .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("v")))
    cc = o.filter(F.year("o_orderdate") > 1995).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("v"))
    return AN.reconcile({"recaudacion": a, "ventas": b, "atencion": cc}, "o_orderstatus", "v")


@proof("AN-13", """WITH p AS (SELECT CASE WHEN o_custkey % 4 = 0 THEN 'APPUSER' ELSE 'U' || CAST(o_custkey % 50 AS VARCHAR) END AS u, CAST(o_orderdate AS DATE) AS f,
  CASE WHEN o_orderkey % 9 > 0 THEN o_orderpriority END AS fp, CASE WHEN o_custkey % 3 = 0 THEN 'OFICINA VIRTUAL ' || CAST(o_custkey % 2 AS VARCHAR) ELSE 'CENTRO' END AS o FROM orders)
SELECT 'General' AS tabla, u AS usuario, f AS fecha, fp AS forma, o AS oficina, NULL::VARCHAR AS categoria, count(*) AS cantidad FROM p WHERE fp IS NOT NULL GROUP BY 2, 3, 4, 5
UNION ALL SELECT 'Usuarios_App', u, NULL, fp, o, NULL, count(*) FROM p WHERE fp IS NOT NULL AND u = 'APPUSER' GROUP BY 2, 4, 5
UNION ALL SELECT 'Oficinas_Virtuales', u, NULL, fp, o, NULL, count(*) FROM p WHERE fp IS NOT NULL AND contains(o, 'VIRTUAL') GROUP BY 2, 4, 5
UNION ALL SELECT 'Categorias_Virtuales', NULL, NULL, NULL, NULL, CASE WHEN u = 'APPUSER' THEN 'App' ELSE 'Manual' END, count(*) FROM p WHERE contains(o, 'VIRTUAL') GROUP BY 6""")
def an13(spark, d):
    k = F.col("o_custkey")
    p = Tables(spark, d).orders.select(
        F.when(k % 4 == 0, "APPUSER").otherwise(F.concat(F.lit("U"), (k % 50).cast("string"))).alias("Usuario"), F.to_date("o_orderdate").alias("Fecha"),
        F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderpriority")).alias("Forma de Pago"),
        F.when(k % 3 == 0, F.concat(F.lit("OFICINA VIRTUAL "), (k % 2).cast("string"))).otherwise("CENTRO").alias("Oficina Cobro"))
    out = None
    for name, t in AN.virtual_payments(p, ["APPUSER"]).items():
        have = lambda n, kind="string": (c(n) if n in t.columns else F.lit(None)).cast(kind)  # noqa: B023, E731
        part = t.select(F.lit(name).alias("tabla"), have("Usuario").alias("usuario"), have("Fecha", "date").alias("fecha"), have("Forma de Pago").alias("forma"),
                        have("Oficina Cobro").alias("oficina"), have("Categoria").alias("categoria"), "cantidad")
        out = part if out is None else out.unionByName(part)
    return out


@proof("AN-14", """WITH j AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, l_returnflag, CASE WHEN l_shipdate IS NULL OR o_orderdate IS NULL THEN NULL
  ELSE greatest(round_even(date_diff('microsecond', o_orderdate, l_shipdate) / 60000000.0::DOUBLE, 2), 0.0) END AS m
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT anio, median(m) FILTER (WHERE l_returnflag = 'A') AS med_a, median(m) FILTER (WHERE l_returnflag = 'N') AS med_n,
  median(m) FILTER (WHERE l_returnflag = 'R') AS med_r, round(avg(m), 4) AS media FROM j GROUP BY 1""")
def an14(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.year("o_orderdate").alias("anio"), "l_returnflag", D.minutes_between("l_shipdate", "o_orderdate").alias("m"))
    p = j.groupBy("anio").pivot("l_returnflag", ["A", "N", "R"]).agg(F.median("m"))
    mean = j.groupBy("anio").agg(F.round(F.avg("m"), 4).alias("media"))
    return p.withColumnsRenamed({"A": "med_a", "N": "med_n", "R": "med_r"}).join(mean, "anio")


@proof("AN-15", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def an15(spark, d):
    t = Tables(spark, d)
    return J.right_only(t.lineitem, t.orders.select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey")


ST01_SQL = """WITH mu AS (SELECT l_returnflag, avg(l_extendedprice) AS m, count(l_extendedprice)::DOUBLE AS n FROM lineitem GROUP BY 1),
mo AS (SELECT l.l_returnflag, mu.n, avg(pow(l_extendedprice - mu.m, 2)) AS m2, avg(pow(l_extendedprice - mu.m, 3)) AS m3,
  avg(pow(l_extendedprice - mu.m, 4)) AS m4 FROM lineitem l JOIN mu ON l.l_returnflag = mu.l_returnflag GROUP BY 1, 2),
g AS (SELECT l_returnflag, n, m3 / pow(m2, 1.5) AS g1, m4 / pow(m2, 2) AS b2 FROM mo),
z0 AS (SELECT *, g1 * sqrt(((n + 1) * (n + 3)) / (6.0 * (n - 2))) AS y0,
  (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) AS beta2 FROM g),
z1 AS (SELECT *, -1 + sqrt(2 * (beta2 - 1)) AS w2 FROM z0),
z2 AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2.0 / (w2 - 1)) AS alpha, CASE WHEN y0 = 0 THEN 1.0 ELSE y0 END AS y FROM z1),
z3 AS (SELECT *, delta * ln(y / alpha + sqrt((y / alpha) * (y / alpha) + 1)) AS zs, 3.0 * (n - 1) / (n + 1) AS e,
  24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1.0) * (n + 3) * (n + 5)) AS varb2 FROM z2),
z4 AS (SELECT *, (b2 - e) / sqrt(varb2) AS x,
  6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt((6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3))) AS sb1 FROM z3),
z5 AS (SELECT *, 6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / (sb1 * sb1))) AS a FROM z4),
z6 AS (SELECT *, 1 - 2 / (9.0 * a) AS term1, 1 + x * sqrt(2 / (a - 4.0)) AS denom FROM z5),
z7 AS (SELECT *, sign(denom) * pow((1 - 2.0 / a) / abs(denom), 1 / 3.0) AS term2 FROM z6),
z8 AS (SELECT *, (term1 - term2) / sqrt(2 / (9.0 * a)) AS zk FROM z7)
SELECT l_returnflag, n, round(zs * zs + zk * zk, 3) AS k2, round(exp(-(zs * zs + zk * zk) / 2), 6) AS p_value,
  exp(-(zs * zs + zk * zk) / 2) > 0.05 AS es_normal FROM z8"""


@proof("ST-01", ST01_SQL)
def st01(spark, d):
    r = STT.normality_test(Tables(spark, d).lineitem, "l_extendedprice", by=["l_returnflag"])
    return r.select("l_returnflag", "n", F.round("k2", 3).alias("k2"), F.round("p_value", 6).alias("p_value"), "es_normal")


# each distinct quantity drawn Poisson(its rows) times in each replicate, from a hash of quantity, replicate and seed
_U = "((('0x' || substr(md5(CAST(CAST(l_quantity AS DECIMAL(38,6)) AS VARCHAR) || '|' || CAST(r AS VARCHAR) || '|42'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"
ST02_SQL = f"""WITH g AS (SELECT l_quantity, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1),
u AS (SELECT l_quantity, n, r, {_U} AS u FROM g, range(0, 2000) t(r)),
z AS (SELECT *, {STT.normal_quantile_sql('u')} AS z FROM u),
w AS (SELECT r, l_quantity, CASE WHEN n <= {STT.SMALL} THEN len(list_filter({STT.small_cdf_sql()}[CAST(n AS INTEGER)], lambda x: x <= u))::DOUBLE
  ELSE greatest(round(n + sqrt(n) * z + (z * z - 1) / 6), 0) END AS w FROM z),
m AS (SELECT r, sum(w * l_quantity) / sum(w) AS m FROM w GROUP BY r)
SELECT round(avg(m), 6) AS media_bootstrap, round(quantile_cont(m, 0.025), 6) AS ic_inferior, round(quantile_cont(m, 0.975), 6) AS ic_superior, count(*) AS replicas FROM m"""


@proof("ST-02", ST02_SQL)
def st02(spark, d):
    b = STT.bootstrap_mean(Tables(spark, d).lineitem, "l_quantity", replicates=2000)
    return b.select(*[F.round(x, 6).alias(x) for x in ("media_bootstrap", "ic_inferior", "ic_superior")], "replicas")


@proof("DQ-02", """SELECT 'orders' AS tabla, count(*) AS filas_leidas, CAST(count(*) - count_if(o_orderstatus = 'F') AS BIGINT) AS filas_eliminadas,
  CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS filas_guardadas FROM orders""")
def dq02(spark, d):
    path = f"{checkpoint_root(spark).rstrip('/')}/strata-dq02-{uuid.uuid4().hex[:12]}"
    return audited_write(Tables(spark, d).orders, lambda o: o.filter(F.col("o_orderstatus") == "F"), path, "orders")


@proof("DQ-03", """WITH m AS (SELECT DISTINCT upper(trim(n_name)) AS k FROM nation WHERE n_regionkey <> 4),
v AS (SELECT DISTINCT n_name AS valor FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT valor FROM v WHERE upper(trim(valor)) NOT IN (SELECT k FROM m)""")
def dq03(spark, d):
    t = Tables(spark, d)
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("oficina"))
    mapping = t.nation.filter(F.col("n_regionkey") != 4)
    return Q.unmapped_values(s, "oficina", mapping, "n_name")


@proof("DQ-04", """SELECT CAST(count_if(o_orderdate >= TIMESTAMP '2000-07-02') AS BIGINT) AS filas_futuras, count(*) AS filas_total FROM orders""")
def dq04(spark, d):
    return Q.future_dates(Tables(spark, d).orders, "o_orderdate", dt.date(2000, 6, 30))


@proof("DQ-05", "SELECT o_custkey, count(*) AS ocurrencias FROM orders GROUP BY 1 HAVING count(*) > 1")
def dq05(spark, d):
    return Q.check_unique(Tables(spark, d).orders, ["o_custkey"])


# ---------------------------------------------------------------- ticket KPIs (row level)


@proof("KPI-01", TICKETS_CTE + "SELECT ticket AS n_orden, res AS sla_resolucion_min FROM silver")
def kpi01(spark, d):
    return silver_slice(Tables(spark, d)).select(c("N° Orden").alias("n_orden"), c(T.RES).alias("sla_resolucion_min"))


@proof("KPI-02", TICKETS_CTE + "SELECT ticket AS n_orden, des AS sla_despacho_min, imp AS sla_impresion_min FROM silver")
def kpi02(spark, d):
    return silver_slice(Tables(spark, d)).select(c("N° Orden").alias("n_orden"), c(T.DISP).alias("sla_despacho_min"),
                                                 c(T.PRINT).alias("sla_impresion_min"))


@proof("KPI-03", TICKETS_CTE + """SELECT ticket AS n_orden, res / 60 AS duracion_horas, CASE WHEN cls = 'ADMINISTRATIVO' THEN 0 ELSE 1 END AS es_falla,
  CASE WHEN res / 60 > 0 AND res / 60 <= 24.0 THEN 1 ELSE 0 END AS cumplio_sla FROM silver""")
def kpi03(spark, d):
    return silver_slice(Tables(spark, d)).select(c("N° Orden").alias("n_orden"), c("Duracion_Horas").alias("duracion_horas"),
                                                 c("Es_Falla").alias("es_falla"), c("Cumplio_SLA").alias("cumplio_sla"))


@proof("KPI-04", TICKETS_CTE + """SELECT 'JUN 1998 Q2' AS quincena_evaluada, franchise AS franquicia, cls AS clasificacion,
  res AS sla_resolucion_min, des AS sla_despacho_min, imp AS sla_impresion_min FROM silver WHERE res IS NOT NULL""")
def kpi04(spark, d):
    s = T.sla_stats_gold(silver_slice(Tables(spark, d)))
    return s.select(c("Quincena Evaluada").alias("quincena_evaluada"), c("Franquicia").alias("franquicia"),
                    c("Clasificacion").alias("clasificacion"), c(T.RES).alias("sla_resolucion_min"),
                    c(T.DISP).alias("sla_despacho_min"), c(T.PRINT).alias("sla_impresion_min"))


@proof("KPI-05", TICKETS_CTE + """, idf AS (SELECT franchise, count(DISTINCT ticket) AS fallas FROM silver GROUP BY 1),
st AS (SELECT n_name, count(DISTINCT o_custkey) AS abonados FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT 'JUN 1998 Q2' AS quincena_evaluada, idf.franchise AS franquicia, idf.fallas AS total_fallas, st.abonados AS total_abonados,
  round(idf.fallas / st.abonados, 6) AS idf FROM idf LEFT JOIN st ON idf.franchise = st.n_name""")
def kpi05(spark, d):
    t = Tables(spark, d)
    silver = silver_slice(t).withColumn("Fecha Cierre Date", F.to_date(c(T.CLOSED)))
    idf = T.idf_gold(silver)
    stock = (t.orders.filter(F.col("o_orderstatus") == "F").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .groupBy(F.col("n_name").alias("Franquicia")).agg(F.count_distinct("o_custkey").alias("Total_Abonados"))
             .withColumn("Quincena Evaluada", F.lit("JUN 1998 Q2")))
    r = T.failure_index(idf, stock)
    return r.select(c("Quincena Evaluada").alias("quincena_evaluada"), c("Franquicia").alias("franquicia"),
                    c("Total_Fallas").alias("total_fallas"), c("Total_Abonados").alias("total_abonados"),
                    F.round("IDF", 6).alias("idf"))


# ---------------------------------------------------------------- UDF surface, native replacements


@proof("UDF-03", """WITH s AS (SELECT o_orderkey, regexp_extract(regexp_replace(regexp_replace('Data - Empleados ' || strftime(o_orderdate, '%d-%m-%Y'),
  '(\\d)[-._/](\\d)', '\\1\\2', 'g'), '(\\d)[-._/](\\d)', '\\1\\2', 'g'), '(\\d{6,8})', 1) AS run FROM orders)
SELECT o_orderkey, coalesce(CAST(try_strptime(right(run, 4) || '-' || substr(run, 3, 2) || '-' || substr(run, 1, 2), '%Y-%m-%d') AS DATE),
  DATE '1900-01-01') AS fecha_archivo FROM s""")
def udf03(spark, d):
    o = Tables(spark, d).orders
    n = F.concat(F.lit("Data - Empleados "), F.date_format("o_orderdate", "dd-MM-yyyy"))
    return o.select("o_orderkey", D.date_token(n).alias("fecha_archivo"))


@proof("UDF-06", f"""SELECT {LABEL_SQL} AS quincena, {KEY_SQL} AS orden, count(*) AS n FROM orders GROUP BY 1, 2""")
def udf06(spark, d):
    o = Tables(spark, d).orders
    q = D.half_label(F.month("o_orderdate"), F.year("o_orderdate"), F.dayofmonth("o_orderdate"))
    g = o.groupBy(q.alias("quincena")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("quincena", D.period_sort_key("quincena").alias("orden"), "n")


def _alias(new_id: str, old_id: str) -> None:
    """UDF-surface rows reuse the native operator that replaces the original
    row-at-a-time Python UDF (same function, same oracle)."""
    from . import REGISTRY, load_all
    load_all()
    fn, sql = REGISTRY[old_id]
    proof(new_id, sql)(fn)


def register_udf_surface() -> None:
    for new_id, old_id in (("UDF-01", "CLS-03"), ("UDF-02", "SC-14"), ("UDF-04", "ER-04"), ("UDF-05", "AGG-09")):
        from . import REGISTRY
        if new_id not in REGISTRY:
            _alias(new_id, old_id)
