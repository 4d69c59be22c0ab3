"""Rule classification and entity-resolution proofs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import fold_text
from ..operators import resolve as R
from ..operators import rules as RU
from ..session import Tables
from . import proof


@proof("CLS-01", """SELECT p_partkey, CASE
  WHEN regexp_matches(upper(coalesce(p_name, '')), 'GIZMO') THEN 'ADMINISTRATIVO'
  WHEN trim(upper(coalesce(p_brand, ''))) IN ('BRAND#1', 'BRAND#2') THEN 'NOC'
  WHEN trim(upper(coalesce(p_type, ''))) IN ('BRAND#1', 'BRAND#2') THEN 'NOC'
  WHEN regexp_matches(upper(coalesce(p_brand, '')), '#3') THEN 'NOC'
  WHEN regexp_matches(upper(coalesce(p_type, '')), 'PROMO|ECONOMY') THEN 'OPERACIONES'
  WHEN regexp_matches(upper(coalesce(p_name, '')), 'RING|BOLT') THEN 'OPERACIONES'
  WHEN regexp_matches(upper(coalesce(p_name, '')), 'WIDGET') THEN 'NOC'
  ELSE 'N/S' END AS clasificacion FROM part""")
def cls01(spark, d):
    rules = RU.ticket_rules(admin=["gizmo"], noc_users=["Brand#1", "Brand#2"], physical=["ring", "bolt"], logical=["widget"],
                            solution="p_name", user="p_brand", group="p_type", ops_group_pattern="PROMO|ECONOMY",
                            user_marker="#3")
    return Tables(spark, d).part.select("p_partkey", RU.classify(rules, "N/S").alias("clasificacion"))


TOPIC_SQL = "CASE " + " ".join(
    f"WHEN regexp_matches(upper(coalesce(text, '')), '{p}') THEN '{lab}'" for p, lab in RU.TOPIC_RULES) + \
    f" ELSE '{RU.TOPIC_DEFAULT}' END"


@proof("CLS-02", f"SELECT doc_id, {TOPIC_SQL} AS tema FROM documents")
def cls02(spark, d):
    return Tables(spark, d).documents.select("doc_id", RU.topic("text").alias("tema"))


@proof("CLS-03", """WITH s AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Televentas ' || c_mktsegment WHEN 1 THEN 'ventas calle'
    WHEN 2 THEN lower(c_mktsegment) WHEN 3 THEN 'administrador ' || c_name ELSE c_name END AS vendedor,
  CASE WHEN c_acctbal > 5000 THEN c_name END AS nombre_detectado,
  CASE WHEN c_acctbal > 8000 THEN 'Fuzzy' WHEN c_acctbal > 5000 THEN 'Pendiente de Revisión' ELSE 'No detectado' END AS tipo
  FROM customer),
n AS (SELECT *, lower(coalesce(vendedor, 'none')) AS v, coalesce(nombre_detectado, 'nan') AS nd, coalesce(tipo, 'nan') AS tp FROM s)
SELECT c_custkey, CASE WHEN contains(v, 'televentas') OR contains(v, 'call center') THEN 'CALL CENTER'
  WHEN (nd <> 'nan' AND nd <> '' AND tp <> 'Pendiente de Revisión' AND tp <> 'No detectado' AND NOT contains(v, 'administrador'))
    OR v IN ('household') THEN 'OFICINA COMERCIAL'
  WHEN (contains(v, 'ventas') AND NOT contains(v, 'televentas')) OR v IN ('machinery') THEN 'VENDEDORES PROPIOS'
  ELSE 'ALIADOS' END AS canal FROM n""")
def cls03(spark, d):
    cu = Tables(spark, d).customer
    k = F.col("c_custkey") % 6
    v = (F.when(k == 0, F.concat(F.lit("Televentas "), "c_mktsegment")).when(k == 1, F.lit("ventas calle"))
         .when(k == 2, F.lower("c_mktsegment")).when(k == 3, F.concat(F.lit("administrador "), "c_name")).otherwise(F.col("c_name")))
    nd = F.when(F.col("c_acctbal") > 5000, F.col("c_name"))
    tp = (F.when(F.col("c_acctbal") > 8000, "Fuzzy").when(F.col("c_acctbal") > 5000, "Pendiente de Revisión")
          .otherwise("No detectado"))
    s = cu.select("c_custkey", v.alias("vendedor"), nd.alias("nombre_detectado"), tp.alias("tipo"))
    return s.select("c_custkey", RU.sales_channel("vendedor", "nombre_detectado", "tipo", ["household"], ["machinery"]).alias("canal"))


@proof("CLS-04", """WITH s AS (SELECT s_suppkey, n_name AS oficina, CASE s_suppkey % 3 WHEN 0 THEN 'call ' || s_name WHEN 1 THEN 'Asesor ' || s_name
  ELSE s_name END AS responsable, CASE WHEN s_suppkey % 4 = 0 THEN 'APPUSER' ELSE s_name END AS usuario
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, CASE WHEN coalesce(oficina, '') IN ('NATION_1', 'NATION_2') THEN 'OFICINAS PROPIAS' ELSE 'ALIADOS Y DESARROLLO' END AS clasificacion,
  CASE WHEN regexp_matches(coalesce(responsable, ''), '(?i)CALL|PHONE') THEN 'CALL CENTER'
    WHEN regexp_matches(coalesce(responsable, ''), '(?i)OFI|ASESOR') THEN 'OFICINA COMERCIAL' ELSE 'ALIADOS' END AS canal,
  CASE WHEN usuario IN ('APPUSER') THEN 'App' ELSE 'Manual' END AS categoria FROM s""")
def cls04(spark, d):
    t = Tables(spark, d)
    k = F.col("s_suppkey") % 3
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_name").alias("oficina"),
        F.when(k == 0, F.concat(F.lit("call "), "s_name")).when(k == 1, F.concat(F.lit("Asesor "), "s_name"))
        .otherwise(F.col("s_name")).alias("responsable"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit("APPUSER")).otherwise(F.col("s_name")).alias("usuario"))
    return s.select("s_suppkey", RU.office_ownership("oficina", ["NATION_1", "NATION_2"]).alias("clasificacion"),
                    RU.responsible_channel("responsable").alias("canal"), RU.app_or_manual("usuario", ["APPUSER"]).alias("categoria"))


def _er_inputs(t):
    """Master names of two and three words; sellers are these names, some with a letter lost, some with a word more."""
    part = t.part
    full = F.concat_ws(" ", "p_name", F.lower("p_type"))
    master = part.select(F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(full).alias("nombre"), "p_brand", "p_partkey")
    master = R.prepare_master(master, ["nombre"], "p_brand", exclude_regex=r"\bgear\b", order_col="p_partkey")
    k = F.col("p_partkey") % 5
    name = (F.when(k == 0, full).when(k == 1, F.expr("left(concat(p_name, ' ', lower(p_type)), length(p_name) + length(p_type))"))
            .when(k == 2, F.expr("concat(substr(p_name, 2), ' ', lower(p_type))")).when(k == 3, F.concat(full, F.lit(" promo"))).otherwise(F.concat(F.lit("x"), full)))
    return master, part.select(name.alias("vendedor"))


def folded_sql(x):
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"


def lcs_sql(s, w):
    """Length of the longest common subsequence of two strings: rows of the table, one letter of ``s`` after the other."""
    row = f"list_transform(range(0, length({w}) + 1), lambda j: CASE WHEN j > 0 AND substr({w}, j, 1) = substr({s}, i, 1) THEN 1::BIGINT ELSE 0 END)"
    best = "list_max(list_transform(range(1, j + 1), lambda k: greatest(a[k], CASE WHEN k > 1 THEN a[k - 1] + m[k] ELSE 0 END)))"
    return (f"list_reduce(list_prepend(list_transform(range(0, length({w}) + 1), lambda j: 0::BIGINT), list_transform(range(1, length({s}) + 1), "
            f"lambda i: {row})), lambda a, m: list_transform(range(1, len(m) + 1), lambda j: {best}))[-1]")


ER_NAME = "CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ' ' || lower(p_type) END"
ER_SELLER = ("CASE p_partkey % 5 WHEN 0 THEN p_name || ' ' || lower(p_type) WHEN 1 THEN left(p_name || ' ' || lower(p_type), length(p_name) + length(p_type)) "
             "WHEN 2 THEN substr(p_name, 2) || ' ' || lower(p_type) WHEN 3 THEN p_name || ' ' || lower(p_type) || ' promo' ELSE 'x' || p_name || ' ' || lower(p_type) END")


def token_set_sql(q, m):
    """All pairs of ``q`` (q) and ``m`` (name, value) whose token-set score is 95 or more: (q, name, value, score)."""
    return f"""p AS (SELECT q, name, value, list_distinct(string_split(q, ' ')) AS tq, list_distinct(string_split(name, ' ')) AS tm FROM {q}, {m}),
r AS (SELECT q, name, value, len(list_intersect(tq, tm)) AS shared, length(array_to_string(list_intersect(tq, tm), ' ')) AS sl,
  array_to_string(list_sort(list_filter(tq, lambda x: NOT list_contains(tm, x))), ' ') AS ab,
  array_to_string(list_sort(list_filter(tm, lambda x: NOT list_contains(tq, x))), ' ') AS ba FROM p),
l AS (SELECT *, sl + least(shared, 1) + length(ab) AS la, sl + least(shared, 1) + length(ba) AS lb FROM r),
s AS (SELECT q, name, value, CASE WHEN shared > 0 AND (ab = '' OR ba = '') THEN 100.0::DOUBLE ELSE greatest(
    CASE WHEN abs(length(ab) - length(ba)) > 0.06 * (la + lb) THEN 0.0
      ELSE 100.0::DOUBLE * (1 - (length(ab) + length(ba) - 2 * coalesce({lcs_sql('ab', 'ba')}, 0))::DOUBLE / (la + lb)) END,
    CASE WHEN shared > 0 THEN 100.0::DOUBLE * (1 - (1 + length(ab))::DOUBLE / (sl + la)) ELSE 0 END,
    CASE WHEN shared > 0 THEN 100.0::DOUBLE * (1 - (1 + length(ba))::DOUBLE / (sl + lb)) ELSE 0 END) END AS score FROM l)"""


ER_BEST = f"""mraw AS (SELECT {ER_NAME} AS nombre, p_brand, p_partkey FROM part WHERE NOT regexp_matches({ER_NAME}, '(?i)\\bgear\\b')),
m AS (SELECT name, value FROM (SELECT {folded_sql('nombre')} AS name, p_brand AS value,
  row_number() OVER (PARTITION BY {folded_sql('nombre')} ORDER BY p_partkey DESC, p_brand DESC) AS rn FROM mraw) WHERE rn = 1),
q AS (SELECT DISTINCT {folded_sql(ER_SELLER)} AS q FROM part),
{token_set_sql('q', 'm')},
b AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, length(name) DESC, name ASC) AS rn FROM s WHERE score >= 95)"""
ER_SQL = f"WITH {ER_BEST} SELECT q, name AS match_name, round(score, 6) AS score, value AS match_value FROM b WHERE rn = 1"


@proof("ER-01", ER_SQL)
def er01(spark, d):
    master, names = _er_inputs(Tables(spark, d))
    return R.fuzzy_lookup(names, "vendedor", master).withColumn("score", F.round("score", 6))


@proof("JON-10", ER_SQL)
def jon10(spark, d):
    return er01(spark, d)


# the second master: suppliers' names as they are and with a letter less
ER02_SQL = f"""WITH {ER_BEST},
m2raw AS (SELECT {folded_sql("replace(s_name, '#', ' ')")} AS name, 'R' || CAST(s_nationkey AS VARCHAR) AS v FROM supplier),
m2 AS (SELECT name, max(v) AS value FROM m2raw GROUP BY name),
sellers AS (SELECT {ER_SELLER} AS vendedor FROM part UNION ALL SELECT CASE WHEN s_suppkey % 2 = 0 THEN replace(s_name, '#', ' ') ELSE replace(s_name, 'Supplier#', 'suplier ') END FROM supplier),
q2 AS (SELECT DISTINCT {folded_sql('vendedor')} AS q FROM sellers),
q3 AS (SELECT q FROM q2 WHERE contains(q, 'lier')),
best1 AS (SELECT q, value FROM b WHERE rn = 1),
best2 AS (SELECT q, value FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, length(name) DESC, name ASC) AS rn FROM (
  SELECT q, name, value, CASE WHEN len(list_intersect(string_split(q, ' '), string_split(name, ' '))) = 0 THEN 0
    WHEN q = name THEN 100.0 ELSE 100.0 * (1 - (length(q) + length(name) - 2 * 9 - 2 * {lcs_sql("string_split(q, ' ')[1]", "string_split(name, ' ')[1]")} - 2)::DOUBLE / (length(q) + length(name))) END AS score
  FROM q3, m2 WHERE string_split(q, ' ')[2] = string_split(name, ' ')[2]) WHERE score >= 95) WHERE rn = 1)
SELECT vendedor, 'SIN OFICINA' AS "Oficina", coalesce(best1.value, best2.value,
  CASE WHEN contains(upper({folded_sql('vendedor')}), 'GEAR') THEN 'ALIADO / AGENTE' WHEN contains(upper({folded_sql('vendedor')}), 'PROMO') THEN 'FUERZA DE VENTA EXTERNA' END,
  'SIN OFICINA') AS oficina_asignada FROM sellers LEFT JOIN best1 ON {folded_sql('vendedor')} = best1.q LEFT JOIN best2 ON {folded_sql('vendedor')} = best2.q"""


@proof("ER-02", ER02_SQL)
def er02(spark, d):
    t = Tables(spark, d)
    master, names = _er_inputs(t)
    plain = F.replace("s_name", F.lit("#"), F.lit(" "))
    second = R.prepare_master(t.supplier.select(plain.alias("nombre"), F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("oficina")), ["nombre"], "oficina")
    more = t.supplier.select(F.when(F.col("s_suppkey") % 2 == 0, plain).otherwise(F.replace("s_name", F.lit("Supplier#"), F.lit("suplier "))).alias("vendedor"))
    df = names.unionByName(more).withColumn("Oficina", F.lit("SIN OFICINA"))
    return R.resolve_with_fallback(df, "vendedor", [master, second],
                                   [(["gear"], "ALIADO / AGENTE"), (["PROMO"], "FUERZA DE VENTA EXTERNA")],
                                   "Oficina", "oficina_asignada")


@proof("ER-03", """SELECT name, value FROM (SELECT trim(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS name,
  p_brand AS value, row_number() OVER (PARTITION BY trim(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))
  ORDER BY p_partkey DESC, p_brand DESC) AS rn FROM part WHERE NOT regexp_matches(p_name, '(?i)\\bgear\\b')) WHERE rn = 1""")
def er03(spark, d):
    return R.prepare_master(Tables(spark, d).part, ["p_name"], "p_brand", exclude_regex=r"\bgear\b", order_col="p_partkey")


ER04_SQL = f"""WITH m AS (SELECT n, a, e, o FROM (SELECT split_part(p_name, ' ', 1) AS n, split_part(p_name, ' ', 2) AS a, p_type AS e, p_brand AS o,
    row_number() OVER (PARTITION BY p_name ORDER BY p_type, p_brand) AS rn FROM part) WHERE rn = 1),
x AS (SELECT DISTINCT CASE p_partkey % 7 WHEN 0 THEN 'vendedor ' || p_name WHEN 1 THEN replace(p_name, 'i', 'y') WHEN 2 THEN 'ofic ' || p_brand
  WHEN 3 THEN 'agente ' || p_name WHEN 4 THEN substr(p_name, 2) WHEN 5 THEN upper(p_name) || ' 2024' ELSE 'Ñandú ' || p_type END AS texto FROM part),
t AS (SELECT texto, translate(lower(texto), '{R.ACCENTED}', '{R.PLAIN}') AS low FROM x),
g AS (SELECT *, regexp_matches(low, '\\b(?:ventas|ventas calle|agente)\\b') AS generic FROM t),
parts AS (SELECT n AS part FROM m UNION SELECT a FROM m),
pairs AS (SELECT low, part, part AS s, low AS w FROM (SELECT DISTINCT low FROM g WHERE NOT generic), parts WHERE length(part) <= length(low)
  UNION ALL SELECT low, part, low, part FROM (SELECT DISTINCT low FROM g WHERE NOT generic), parts WHERE length(part) >= length(low)),
windows AS (SELECT DISTINCT low, part, s, substr(w, CAST(greatest(i, 0) AS BIGINT) + 1, CAST(length(s) + least(i, 0) AS BIGINT)) AS w
  FROM (SELECT *, unnest(range(1 - length(s), length(w))) AS i FROM pairs)),
scores AS (SELECT low, part, max(200.0::DOUBLE * {lcs_sql('s', 'w')} / (length(s) + length(w))) AS score FROM windows GROUP BY 1, 2),
f AS (SELECT x.low, m.n, m.a, m.e, m.o, x.score AS sn, y.score AS sa, (x.score + y.score) / 2 AS mean, contains(x.low, m.n || ' ' || m.a) AS exact
  FROM m JOIN scores x ON x.part = m.n JOIN scores y ON y.part = m.a AND y.low = x.low),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY low ORDER BY exact DESC, CASE WHEN exact THEN 0 ELSE -mean END, n, a) AS rn FROM f WHERE mean >= 86) WHERE rn = 1),
j AS (SELECT g.*, b.n, b.a, b.e, b.o, b.exact, CASE WHEN exact THEN 100.0 ELSE sn END AS sn, CASE WHEN exact THEN 100.0 ELSE sa END AS sa,
  CASE WHEN exact THEN 100.0 ELSE mean END AS mean, NOT generic AND b.n IS NULL AND regexp_matches(g.low, 'ofi\\w*') AS office
  FROM g LEFT JOIN b ON b.low = g.low AND NOT generic)
SELECT texto, CASE WHEN office THEN texto ELSE n || ' ' || a END AS nombre_detectado, e AS "Estado",
  CASE WHEN office THEN trim(regexp_extract(low, 'ofi\\w*\\s*(.*)', 1)) ELSE o END AS oficina_comercial,
  CASE WHEN generic OR (n IS NULL AND NOT office) THEN 'No detectado' WHEN office THEN 'Oficina Detectada' WHEN exact THEN 'Exacta'
    WHEN mean >= 90 THEN 'Fuzzy' ELSE 'Pendiente de Revisión' END AS tipo_coincidencia,
  sn::DOUBLE AS fuzzy_score_nombre, sa::DOUBLE AS fuzzy_score_apellido, mean::DOUBLE AS fuzzy_score_combinado FROM j"""


@proof("ER-04", ER04_SQL)
def er04(spark, d):
    p = Tables(spark, d).part
    master = p.select(F.split("p_name", " ")[0].alias("Nombre"), F.split("p_name", " ")[1].alias("Apellido"),
                      F.col("p_type").alias("Estado"), F.col("p_brand").alias("Oficina"))
    k = F.col("p_partkey") % 7
    text = (F.when(k == 0, F.concat(F.lit("vendedor "), "p_name")).when(k == 1, F.replace("p_name", F.lit("i"), F.lit("y")))
            .when(k == 2, F.concat(F.lit("ofic "), "p_brand")).when(k == 3, F.concat(F.lit("agente "), "p_name"))
            .when(k == 4, F.expr("substr(p_name, 2)")).when(k == 5, F.concat(F.upper("p_name"), F.lit(" 2024")))
            .otherwise(F.concat(F.lit("Ñandú "), "p_type")))
    return R.identify(p.select(text.alias("Vendedor")), "Vendedor", master)


@proof("ER-05", """SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)small') AND regexp_matches(p_name, '(?i)ring')
  THEN 'OFICINA CENTRO' ELSE p_brand END AS oficina,
  CASE WHEN regexp_matches(p_name, '(?i)small') AND regexp_matches(p_name, '(?i)ring') THEN 'Oficina Detectada' ELSE NULL END AS tipo
  FROM part""")
def er05(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name", F.col("p_brand").alias("oficina"))
    out = R.place_override(p, "p_name", ["small", "ring"], {"oficina": "OFICINA CENTRO", "tipo": "Oficina Detectada"})
    return out.select("p_partkey", "oficina", "tipo")
