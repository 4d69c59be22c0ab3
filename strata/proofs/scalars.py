"""Scalar function proofs (SC-*). Text/garbage/format cases are injected with
deterministic expressions written identically in the SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as K
from ..functions import dates as D
from ..session import Tables
from . import proof

NAMES_UP_SQL = "['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SEPTIEMBRE','OCTUBRE','NOVIEMBRE','DICIEMBRE']"
ABBR_SQL = "['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SEP','OCT','NOV','DIC']"
NAMES_SQL = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"


def _garbage_part(t):
    k = F.col("p_partkey") % 8
    raw = (F.when(k == 0, "nan").when(k == 1, "NaN").when(k == 2, "None").when(k == 3, "")
           .when(k == 4, "   ").when(k == 5, "Nan").when(k == 6, " a ").otherwise(F.col("p_name")))
    return t.part.select("p_partkey", raw.alias("raw"))


GARBAGE_SQL = """
WITH g AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'nan' WHEN 1 THEN 'NaN' WHEN 2 THEN 'None'
  WHEN 3 THEN '' WHEN 4 THEN '   ' WHEN 5 THEN 'Nan' WHEN 6 THEN ' a ' ELSE p_name END AS raw FROM part)
"""


@proof("SC-01", GARBAGE_SQL + """
SELECT p_partkey, raw,
  CASE WHEN trim(raw) = '' OR raw IN ('nan','NaN','NAN','None','null','Null','') THEN NULL ELSE raw END AS cleaned,
  CASE WHEN trim(raw) = '' OR lower(trim(raw)) IN ('nan','none','null') THEN NULL ELSE raw END AS cleaned_trim
FROM g""")
def sc01(spark, d):
    g = _garbage_part(Tables(spark, d))
    return g.select("p_partkey", "raw", K.garbage_to_null("raw").alias("cleaned"),
                    K.garbage_to_null("raw", trim_values=True).alias("cleaned_trim"))


@proof("SC-02", """
WITH s AS (SELECT o_orderkey, CASE o_orderkey % 4
    WHEN 0 THEN CAST(o_custkey AS VARCHAR) || '.0'
    WHEN 1 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
    WHEN 2 THEN ' nan '
    ELSE replace(format('{:,}', o_custkey * 1000 + 7), ',', '.') END AS id_raw FROM orders),
n AS (SELECT o_orderkey, id_raw, replace(regexp_replace(trim(id_raw), '\\.0$', ''), '.', '') AS x FROM s)
SELECT o_orderkey, id_raw, CASE WHEN x IN ('nan','None','') THEN NULL ELSE x END AS id_norm FROM n""")
def sc02(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey") % 4
    ck = F.col("o_custkey").cast("string")
    dotted = F.replace(F.format_number(F.col("o_custkey") * 1000 + 7, 0), F.lit(","), F.lit("."))
    raw = (F.when(k == 0, F.concat(ck, F.lit(".0"))).when(k == 1, F.concat(F.lit(" "), ck, F.lit(" ")))
           .when(k == 2, F.lit(" nan ")).otherwise(dotted))
    return o.select("o_orderkey", raw.alias("id_raw")).select("o_orderkey", "id_raw", K.normalize_id("id_raw").alias("id_norm"))


DATE_FMT_SQL = """
WITH s AS (SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 4 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE '31/02/' || CAST(year(o_orderdate) AS VARCHAR) END AS txt FROM orders)
"""


@proof("SC-03", DATE_FMT_SQL + """
SELECT o_orderkey, txt, CAST(coalesce(try_strptime(txt, '%Y-%m-%d %H:%M:%S'), try_strptime(txt, '%Y-%m-%d'),
  try_strptime(txt, '%d/%m/%Y %H:%M:%S'), try_strptime(txt, '%d/%m/%Y'), try_strptime(txt, '%d-%m-%Y')) AS DATE) AS parsed
FROM s""")
def sc03(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey") % 6
    od = F.col("o_orderdate")
    txt = (F.when(k == 0, F.date_format(od, "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format(od, "yyyy-MM-dd"))
           .when(k == 2, F.date_format(od, "dd/MM/yyyy HH:mm:ss")).when(k == 3, F.date_format(od, "dd/MM/yyyy"))
           .when(k == 4, F.date_format(od, "dd-MM-yyyy")).otherwise(F.concat(F.lit("31/02/"), F.year(od).cast("string"))))
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", "txt", D.parse_date("txt").alias("parsed"))


@proof("SC-04", """
WITH s AS (SELECT o_orderkey, CASE o_orderkey % 3
    WHEN 0 THEN CAST(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)) AS VARCHAR)
    WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
    ELSE CASE WHEN o_orderkey % 2 = 0 THEN '35000' ELSE '60000' END END AS txt FROM orders),
n AS (SELECT *, try_cast(txt AS DOUBLE) AS num FROM s)
SELECT o_orderkey, txt, CASE WHEN num > 35000 AND num < 60000
    THEN TIMESTAMP '1970-01-01' + to_microseconds(CAST(round((num - 25569) * 86400000000.0) AS BIGINT))
    ELSE coalesce(try_strptime(txt, '%d/%m/%Y %H:%M:%S'), try_strptime(txt, '%d/%m/%Y %H:%M'), try_strptime(txt, '%d/%m/%Y'),
      try_strptime(txt, '%d-%m-%Y %H:%M:%S'), try_strptime(txt, '%d-%m-%Y'), try_strptime(txt, '%Y-%m-%d %H:%M:%S'),
      try_strptime(txt, '%Y-%m-%d')) END AS parsed
FROM n""")
def sc04(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey") % 3
    serial = F.datediff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")
    txt = (F.when(k == 0, serial).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
           .otherwise(F.when(F.col("o_orderkey") % 2 == 0, F.lit("35000")).otherwise(F.lit("60000"))))
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", "txt", D.parse_mixed("txt").alias("parsed"))


@proof("SC-05", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def sc05(spark, d):
    return Tables(spark, d).events.select("event_id", D.day_of("ts").alias("day"))


HOUR_SQL = """
WITH s AS (SELECT event_id, CASE WHEN event_id % 10 = 9 THEN 'xx' WHEN event_id % 3 = 0
      THEN strftime(ts, '%-I:%M') || CASE WHEN hour(ts) < 12 THEN ' a. m.' ELSE ' p. m.' END
    WHEN event_id % 3 = 1 THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M') END AS hora FROM events),
n AS (SELECT *, upper(replace(replace(lower(trim(hora)), '.', ''), ' ', '')) AS h FROM s)
"""
HOUR_PARSE_SQL = ("strftime(coalesce(try_strptime(h, '%I:%M%p'), try_strptime(h, '%I:%M:%S%p'), "
                  "try_strptime(h, '%H:%M'), try_strptime(h, '%H:%M:%S')), '%H:00')")


def _hours(spark, d):
    e = Tables(spark, d).events
    k3 = F.col("event_id") % 3
    twelve = F.concat(F.date_format("ts", "h:mm"), F.when(F.hour("ts") < 12, F.lit(" a. m.")).otherwise(F.lit(" p. m.")))
    txt = (F.when(F.col("event_id") % 10 == 9, F.lit("xx")).when(k3 == 0, twelve)
           .when(k3 == 1, F.date_format("ts", "HH:mm:ss")).otherwise(F.date_format("ts", "HH:mm")))
    return e.select("event_id", txt.alias("hora"))


@proof("SC-06", HOUR_SQL + f"SELECT event_id, hora, {HOUR_PARSE_SQL} AS hora_bloque FROM n")
def sc06(spark, d):
    return _hours(spark, d).select("event_id", "hora", D.hour_bucket("hora").alias("hora_bloque"))


@proof("SC-07", HOUR_SQL + f"SELECT event_id, hora, coalesce({HOUR_PARSE_SQL}, '00:00') AS hora_bloque FROM n")
def sc07(spark, d):
    return _hours(spark, d).select("event_id", "hora", D.hour_bucket("hora", default="00:00").alias("hora_bloque"))


@proof("SC-08", f"""
SELECT o_orderkey, {NAMES_SQL}[month(o_orderdate)] AS mes, lower({NAMES_SQL}[month(o_orderdate)]) AS mes_lower,
  {ABBR_SQL}[month(o_orderdate)] AS mes_abbr FROM orders""")
def sc08(spark, d):
    m = F.month("o_orderdate")
    return Tables(spark, d).orders.select("o_orderkey", D.month_name_es(m).alias("mes"),
                                          D.month_name_es(m, "lower").alias("mes_lower"),
                                          D.month_name_es(m, "abbr").alias("mes_abbr"))


@proof("SC-09", f"""
WITH s AS (SELECT o_orderkey, year(o_orderdate) AS anio,
  CASE WHEN o_orderkey % 11 = 0 THEN 'Foo' ELSE ' ' || upper({NAMES_SQL}[month(o_orderdate)]) END AS mes FROM orders),
n AS (SELECT *, list_position({NAMES_UP_SQL}, upper(trim(mes))) AS p FROM s)
SELECT o_orderkey, mes, CASE WHEN p > 0 THEN p END AS mes_num,
  CASE WHEN p > 0 THEN make_date(anio, p, 1) END AS fecha FROM n""")
def sc09(spark, d):
    o = Tables(spark, d).orders
    mes = F.when(F.col("o_orderkey") % 11 == 0, F.lit("Foo")).otherwise(
        F.concat(F.lit(" "), D.month_name_es(F.month("o_orderdate"), "upper")))
    s = o.select("o_orderkey", F.year("o_orderdate").alias("anio"), mes.alias("mes"))
    num = D.month_number_es("mes")
    return s.select("o_orderkey", "mes", num.alias("mes_num"), D.first_of_month(F.col("anio"), num).alias("fecha"))


LO_SQL = "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"


@proof("SC-10", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate IS NULL OR o_orderdate IS NULL THEN NULL
  ELSE greatest(round_even(date_diff('microsecond', o_orderdate, l_shipdate) / 60000000.0::DOUBLE, 2), 0.0) END AS minutos
{LO_SQL}""")
def sc10(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", D.minutes_between("l_shipdate", "o_orderdate").alias("minutos"))


@proof("SC-11", f"""
SELECT l_orderkey, l_linenumber, round(date_diff('microsecond', o_orderdate, l_shipdate) / 86400000000.0::DOUBLE, 4) AS dias,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE) AS dias_enteros
{LO_SQL}""")
def sc11(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", F.round(D.days_between("l_shipdate", "o_orderdate"), 4).alias("dias"),
                    D.days_between("l_shipdate", "o_orderdate", fractional=False).alias("dias_enteros"))


@proof("SC-12", f"""
WITH s AS (SELECT l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS g {LO_SQL})
SELECT l_orderkey, l_linenumber, CASE WHEN g <= 0 THEN '0' WHEN g <= 30 THEN '30' WHEN g <= 60 THEN '60'
  WHEN g <= 120 THEN '120' ELSE '>120' END AS banda FROM s""")
def sc12(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    g = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return j.select("l_orderkey", "l_linenumber",
                    D.band(g, [(0, "0"), (30, "30"), (60, "60"), (120, "120")], ">120").alias("banda"))


@proof("SC-13", """
WITH s AS (SELECT p_partkey, '  ' || replace(p_name, ' ', '   ') || ' ' AS raw FROM part)
SELECT p_partkey, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS limpio,
  upper(trim(regexp_replace(raw, '\\s+', ' ', 'g'))) AS limpio_upper, lower(trim(raw)) AS bajo FROM s""")
def sc13(spark, d):
    p = Tables(spark, d).part
    raw = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit(" "))
    s = p.select("p_partkey", raw.alias("raw"))
    return s.select("p_partkey", K.squish("raw").alias("limpio"), K.upper_squish("raw").alias("limpio_upper"),
                    F.lower(F.trim("raw")).alias("bajo"))


@proof("SC-14", f"""
WITH s AS (SELECT doc_id, trim(regexp_replace(regexp_replace(translate(lower(text), '{K.ACCENTED}', '{K.PLAIN}'),
  '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS f FROM documents)
SELECT doc_id, CAST(length(f) AS INTEGER) AS n_folded, md5(f) AS folded_md5 FROM s""")
def sc14(spark, d):
    docs = Tables(spark, d).documents
    f = K.fold_text("text")
    return docs.select("doc_id", f.alias("f")).select("doc_id", F.length("f").alias("n_folded"),
                                                       F.md5("f").alias("folded_md5"))


_SELLER = "s_name || CASE s_suppkey % 4 WHEN 0 THEN '  ofi. 12/5-B' WHEN 1 THEN '  Peña & Müller (2)' WHEN 2 THEN ' ÷×÷ ' ELSE '' END"


@proof("SC-14-seller", f"""WITH s AS (SELECT s_suppkey, {_SELLER} AS v FROM supplier),
k AS (SELECT s_suppkey, trim(regexp_replace(CASE WHEN regexp_matches(v, '\\d+/\\d+') THEN regexp_replace(v, '[^0-9/\\s]', '', 'g')
  ELSE regexp_replace(v, '[^a-zA-Z0-9\\sÀ-ÖØ-öø-ÿ]', '', 'g') END, '\\s+', ' ', 'g')) AS limpio FROM s)
SELECT s_suppkey, limpio, translate(lower(limpio), '{K.ACCENTED}', '{K.PLAIN}') AS normal FROM k""")
def sc14_seller(spark, d):
    s = Tables(spark, d).supplier.select("s_suppkey", K.clean_seller(F.expr(_SELLER)).alias("limpio"))
    return s.withColumn("normal", F.translate(F.lower("limpio"), K.ACCENTED, K.PLAIN))


@proof("SC-15", """
WITH s AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Oficina ' WHEN 1 THEN 'vendedor ofi ' ELSE '' END
  || p_name AS vendedor FROM part)
SELECT p_partkey, vendedor, nullif(trim(regexp_extract(vendedor, '(?i).*(?:OFICINA|OFIC|OFI)\\s+(.*)$', 1)), '') AS oficina
FROM s""")
def sc15(spark, d):
    p = Tables(spark, d).part
    k = F.col("p_partkey") % 3
    v = F.concat(F.when(k == 0, F.lit("Oficina ")).when(k == 1, F.lit("vendedor ofi ")).otherwise(F.lit("")), "p_name")
    return p.select("p_partkey", v.alias("vendedor")).select("p_partkey", "vendedor",
                                                             K.office_after_marker("vendedor").alias("oficina"))


@proof("SC-16", """
SELECT p_partkey, replace(replace(replace(p_type, 'PROMO', 'PROMOCION'), 'MEDIUM', 'MEDIANO'), 'O', '0') AS tipo FROM part""")
def sc16(spark, d):
    return Tables(spark, d).part.select(
        "p_partkey", K.replace_chain("p_type", [("PROMO", "PROMOCION"), ("MEDIUM", "MEDIANO"), ("O", "0")]).alias("tipo"))


@proof("SC-17", "SELECT c_custkey, trim(split_part(c_name, '#', 1)) AS cabeza, "
                "trim(split_part(c_mktsegment, '#', 1)) AS sin_marca FROM customer")
def sc17(spark, d):
    return Tables(spark, d).customer.select("c_custkey", K.head_before("c_name", "#").alias("cabeza"),
                                            K.head_before("c_mktsegment", "#").alias("sin_marca"))


@proof("SC-18", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE replace(CAST(o_totalprice AS VARCHAR), '.', ',') END AS txt
  FROM orders)
SELECT o_orderkey, txt, coalesce(try_cast(replace(txt, ',', '.') AS DOUBLE), 0.0) AS monto FROM s""")
def sc18(spark, d):
    o = Tables(spark, d).orders
    txt = F.when(F.col("o_orderkey") % 9 == 0, F.lit("n/a")).otherwise(
        F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")))
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", "txt", K.decimal_comma("txt").alias("monto"))


@proof("SC-19", """
WITH s AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE o_orderpriority END AS p FROM orders)
SELECT o_orderkey, coalesce(nullif(trim(p), ''), 'SIN DATO') AS prioridad FROM s""")
def sc19(spark, d):
    o = Tables(spark, d).orders
    k = F.col("o_orderkey") % 5
    p = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lit("  ")).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", p.alias("p")).select("o_orderkey", K.default_if_blank("p", "SIN DATO").alias("prioridad"))


SC20_SQL = f"""
WITH s AS (SELECT o_orderkey,
  'Data - IdF ' || strftime(o_orderdate, '%-d-%-m-%Y') || ' al ' || strftime(o_orderdate + INTERVAL 15 DAY, '%-d-%-m-%Y') || '.xlsx' AS n_a,
  'IdF ' || strftime(o_orderdate, '%-d.%-m.%Y') || ' hasta ' || strftime(o_orderdate + INTERVAL 15 DAY, '%d.%m.%Y') AS n_b,
  'Data - Abonados hasta el ' || strftime(o_orderdate, '%-d.%m.%Y') || '.xlsx' AS n_c,
  'Data - Empleados ' || strftime(o_orderdate, '%d-%m-%Y') || '.xlsx' AS n_d,
  'Data_Abonados' || strftime(o_orderdate, '%d%m%Y') || '.xlsx' AS n_e
  FROM orders),
a AS (SELECT *, regexp_extract(lower(n_a), '(\\d{{1,2}})-(\\d{{1,2}})-(\\d{{4}})\\s+al\\s+(\\d{{1,2}})-(\\d{{1,2}})-(\\d{{4}})', ['d1','m1','y1','d2','m2','y2']) AS ga,
  regexp_extract(lower(n_b), '(\\d{{1,2}})\\W(\\d{{1,2}})\\W(\\d{{4}}).*?(\\d{{1,2}})\\W(\\d{{1,2}})\\W(\\d{{4}})', ['d1','m1','y1','d2','m2','y2']) AS gb,
  regexp_extract(lower(n_c), '(\\d{{1,2}})[\\-./_\\s]+(\\d{{1,2}})[\\-./_\\s]+(\\d{{4}})', ['d','m','y']) AS gc,
  regexp_extract(regexp_replace(regexp_replace(n_d, '(\\d)[-._/](\\d)', '\\1\\2', 'g'), '(\\d)[-._/](\\d)', '\\1\\2', 'g'), '(\\d{{6,8}})', 1) AS run_d,
  regexp_extract(n_e, '(\\d{{2}})(\\d{{2}})(\\d{{4}})', ['d','m','y']) AS ge
  FROM s),
b AS (SELECT *,
  try_strptime(ga.y1 || '-' || ga.m1 || '-' || ga.d1, '%Y-%m-%d') AS a_start, try_strptime(ga.y2 || '-' || ga.m2 || '-' || ga.d2, '%Y-%m-%d') AS a_end,
  try_strptime(gb.y1 || '-' || gb.m1 || '-' || gb.d1, '%Y-%m-%d') AS b_start, try_strptime(gb.y2 || '-' || gb.m2 || '-' || gb.d2, '%Y-%m-%d') AS b_end,
  CAST(try_strptime(gc.y || '-' || gc.m || '-' || gc.d, '%Y-%m-%d') AS DATE) AS c_date,
  substr(run_d, 1, length(run_d) - 4) AS rest_d, right(run_d, 4) AS y_d,
  CAST(try_strptime(ge.y || '-' || ge.m || '-' || ge.d, '%Y-%m-%d') AS DATE) AS e_date
  FROM a),
c AS (SELECT *, CASE WHEN day(c_date) <= 5 THEN date_trunc('month', c_date) - INTERVAL 1 DAY
    WHEN day(c_date) <= 20 THEN date_trunc('month', c_date) + INTERVAL 14 DAY ELSE last_day(c_date) END AS c_cut_ts,
  CASE length(rest_d) WHEN 4 THEN substr(rest_d, 1, 2) WHEN 2 THEN substr(rest_d, 1, 1) WHEN 3 THEN substr(rest_d, 1, 2) END AS dd_d,
  CASE length(rest_d) WHEN 4 THEN substr(rest_d, 3, 2) WHEN 2 THEN substr(rest_d, 2, 1) WHEN 3 THEN substr(rest_d, 3, 1) END AS mm_d
  FROM b)
SELECT o_orderkey,
  a_start, a_end, {ABBR_SQL}[month(a_end)] || ' ' || CAST(year(a_end) AS VARCHAR) || ' ' || CASE WHEN day(a_end) <= 15 THEN 'Q1' ELSE 'Q2' END AS a_label,
  b_start, b_end, {ABBR_SQL}[month(b_end)] || ' ' || CAST(year(b_end) AS VARCHAR) || ' ' || CASE WHEN day(b_end) <= 15 THEN 'Q1' ELSE 'Q2' END AS b_label,
  CAST(c_cut_ts AS DATE) AS c_cut,
  {ABBR_SQL}[month(c_cut_ts)] || ' ' || CAST(year(c_cut_ts) AS VARCHAR) || ' ' || CASE WHEN day(c_date) > 5 AND day(c_date) <= 20 THEN 'Q1' ELSE 'Q2' END AS c_label,
  coalesce(CAST(try_strptime(y_d || '-' || mm_d || '-' || dd_d, '%Y-%m-%d') AS DATE), DATE '1900-01-01') AS d_date,
  e_date,
  CAST(year(a_end) AS VARCHAR) || '-' || lpad(CAST(month(a_end) AS VARCHAR), 2, '0') || '-' || CASE WHEN day(a_end) <= 15 THEN 'Q1' ELSE 'Q2' END AS f_key
FROM c"""


@proof("SC-20", SC20_SQL)
def sc20(spark, d):
    o = Tables(spark, d).orders
    od, od15 = F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 15 DAYS")
    s = o.select(
        "o_orderkey",
        F.concat(F.lit("Data - IdF "), F.date_format(od, "d-M-yyyy"), F.lit(" al "), F.date_format(od15, "d-M-yyyy"),
                 F.lit(".xlsx")).alias("n_a"),
        F.concat(F.lit("IdF "), F.date_format(od, "d.M.yyyy"), F.lit(" hasta "), F.date_format(od15, "dd.MM.yyyy")).alias("n_b"),
        F.concat(F.lit("Data - Abonados hasta el "), F.date_format(od, "d.MM.yyyy"), F.lit(".xlsx")).alias("n_c"),
        F.concat(F.lit("Data - Empleados "), F.date_format(od, "dd-MM-yyyy"), F.lit(".xlsx")).alias("n_d"),
        F.concat(F.lit("Data_Abonados"), F.date_format(od, "ddMMyyyy"), F.lit(".xlsx")).alias("n_e"))
    s = D.with_period(D.with_period(s, "n_a", "a_"), "n_b", "b_", loose=True)
    cc = D.snapshot_cut("n_c")
    return s.select(
        "o_orderkey", "a_start", "a_end", "a_label", "b_start", "b_end", "b_label",
        cc["cut"].alias("c_cut"), cc["label"].alias("c_label"), D.date_token("n_d").alias("d_date"),
        D.ddmmyyyy("n_e", "Data_Abonados").alias("e_date"), D.period_sort_key("a_label").alias("f_key"))


@proof("SC-21", "SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * (1 - l_discount), 2) AS neto, "
                "round_even(l_quantity / 7.0::DOUBLE, 1) AS q7 FROM lineitem")
def sc21(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     D.round_half_even(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("neto"),
                     D.round_half_even(F.col("l_quantity") / F.lit(7.0), 1).alias("q7"))


@proof("SC-22", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount IS NULL THEN NULL ELSE least(l_discount * 100, l_tax * 100, 5.0) END AS tope,
  CASE WHEN l_returnflag = 'R' THEN coalesce(l_discount, 0.0) ELSE l_tax END AS relleno FROM lineitem""")
def sc22(spark, d):
    li = Tables(spark, d).lineitem
    tope = F.when(F.col("l_discount").isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.col("l_discount") * 100, F.col("l_tax") * 100, F.lit(5.0)))
    relleno = F.when(F.col("l_returnflag") == "R", F.coalesce("l_discount", F.lit(0.0))).otherwise(F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", tope.alias("tope"), relleno.alias("relleno"))


@proof("SC-23", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS es_final FROM orders")
def sc23(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", D.indicator(F.col("o_orderstatus") == "F").alias("es_final"))


@proof("SC-24", "SELECT event_id, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00' AS hora FROM events")
def sc24(spark, d):
    return Tables(spark, d).events.select("event_id", F.concat(K.zero_pad(F.hour("ts")), F.lit(":00")).alias("hora"))


@proof("SC-25", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS txt
  FROM orders)
SELECT o_orderkey, coalesce(try_cast(txt AS BIGINT), -1) AS cliente FROM s""")
def sc25(spark, d):
    o = Tables(spark, d).orders
    txt = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("x"), F.col("o_custkey").cast("string"))).otherwise(
        F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", txt.alias("txt")).select("o_orderkey", K.safe_cast("txt", "bigint", -1).alias("cliente"))


@proof("SC-26", "SELECT p_partkey, coalesce(regexp_matches(p_name, '(?i)(?:RING|bolt|Gizmo)'), false) AS tiene FROM part")
def sc26(spark, d):
    return Tables(spark, d).part.select("p_partkey", K.contains_any("p_name", ["RING", "bolt", "Gizmo"]).alias("tiene"))


@proof("SC-27", """
SELECT c_custkey, trim(concat_ws(' ', coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, ''),
  coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END, ''))) AS identidad FROM customer""")
def sc27(spark, d):
    cu = Tables(spark, d).customer
    a = F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    b = F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    return cu.select("c_custkey", K.identity_concat(a, b).alias("identidad"))


@proof("SC-28", "SELECT o_orderkey, 'ORDERS.PARQUET' AS origen FROM orders")
def sc28(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.col("_metadata.file_name").alias("Source.Name"))
    return o.select("o_orderkey", K.source_tag("Source.Name").alias("origen"))
