"""Source and sink proofs on the driver tables (files written by these proofs
are derived from the tables and go to a fresh folder under the session's
checkpoint root)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions.core import c, col_or_default
from ..operators import quality as Q
from ..plans import bronze as BZ
from ..session import TABLES, Tables, checkpoint_root
from ..sources import files as SF
from ..sources import partitioned as PT
from ..sources import workbook as WB
from ..sources.lake import Lake
from . import books as BK
from . import proof


def _scratch(spark) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/strata-io-{uuid.uuid4().hex[:12]}"


@proof("SRC-01", "SELECT * FROM lineitem")
def src01(spark, d):
    return SF.read_parquet(spark, f"{d}/lineitem.parquet")


@proof("SRC-02", """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL BY NAME SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def src02(spark, d):
    o = Tables(spark, d).orders
    root = _scratch(spark)
    cut = F.lit(dt.datetime(1998, 1, 1))
    o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus").write.parquet(f"{root}/part=a")
    o.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_totalprice").write.parquet(f"{root}/part=b")
    return SF.read_parquet(spark, f"{root}/part=a", f"{root}/part=b", merge_schema=True).select(
        "o_orderkey", "o_orderstatus", "o_totalprice")


@proof("SRC-03", "SELECT l_orderkey, l_shipdate FROM lineitem")
def src03(spark, d):
    return Tables(spark, d).lineitem.select("l_orderkey", "l_shipdate")


@proof("SRC-04", "SELECT o_orderkey, o_totalprice AS monto, 'SIN BANCO' AS banco FROM orders")
def src04(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", col_or_default(o, "O_TOTALPRICE", "double").alias("monto"),
                    col_or_default(o, "Banco", "string", "SIN BANCO").alias("banco"))


@proof("SRC-06", """WITH c AS (SELECT c_custkey, c_name, c_acctbal, c_nationkey, 'region_' || CAST(c_nationkey % 5 AS VARCHAR) || '.xls' AS archivo FROM customer)
SELECT archivo, c_name AS nombre, translate(format('{:,.2f}', c_acctbal), ',.', '.,') AS saldo_texto, c_acctbal AS saldo,
  CAST(NULL AS VARCHAR) AS saldo_2 FROM c""")
def src06(spark, d):
    """Customers as HTML tables with decimal commas (exported ``.xls``), read back as text and as numbers."""
    shown = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    row = F.concat(F.lit("<tr><td>"), "c_name", F.lit("</td><td> "), shown, F.lit("</td><td></td></tr>"))
    head = "<html><body><table><tr><th>Nombre</th><th>Saldo</th><th>Saldo</th></tr>"
    files = (Tables(spark, d).customer.groupBy(F.concat(F.lit("region_"), (F.col("c_nationkey") % 5).cast("string"), F.lit(".xls")).alias("archivo"))
             .agg(F.concat(F.lit(head), F.array_join(F.sort_array(F.collect_list(row)), ""), F.lit("</table></body></html>")).alias("html")))
    rows = WB.promote_header(WB.html_tables(files, "archivo", "html"))
    return rows.select(c("Source.Name").alias("archivo"), c("Nombre").alias("nombre"), c("Saldo").alias("saldo_texto"),
                       WB.comma_number("Saldo").alias("saldo"), F.nullif(c("Saldo_2"), F.lit("")).alias("saldo_2"))


def _supplier_books(spark, d, status="A", only=None):
    """Suppliers as workbooks of equal names in two folders; a tenth of the rows has no contract date."""
    root = _scratch(spark)
    k = F.col("s_suppkey")
    s = Tables(spark, d).supplier if only is None else Tables(spark, d).supplier.filter(only)
    s = s.select(F.concat(F.when(k % 2 == 0, "norte").otherwise("sur"), F.lit("/Data_Churn_Risk "), (k % 3).cast("string")).alias("libro"),
                 k.cast("string").alias("N° Abonado"), F.col("s_name").alias("Nombre"),
                 F.when(k % 10 != 9, (36526 + k % 365).cast("double")).alias("Fecha Contrato"), F.lit(status).alias("Estatus"))
    BK.write_workbooks(s, "libro", s.columns[1:], ("Fecha Contrato",), root)
    return root


@proof("SRC-05", """SELECT CAST(s_suppkey AS VARCHAR) AS abonado, s_name AS nombre,
  CASE WHEN s_suppkey % 10 <> 9 THEN strftime(DATE '2000-01-01' + CAST(s_suppkey % 365 AS INTEGER), '%Y-%m-%d') END AS contrato,
  'Data_Churn_Risk ' || CAST(s_suppkey % 3 AS VARCHAR) || '.xlsx' AS libro FROM supplier""")
def src05(spark, d):
    rows, _ = WB.read_workbooks(spark, _supplier_books(spark, d) + "/*")
    return rows.select(c("N° Abonado").alias("abonado"), c("Nombre").alias("nombre"), c("Fecha Contrato").alias("contrato"), c("Source.Name").alias("libro"))


@proof("PL-20", """WITH a AS (SELECT CAST(s_suppkey AS VARCHAR) AS abonado,
  CASE WHEN s_suppkey % 10 <> 9 THEN DATE '2000-01-01' + CAST(s_suppkey % 365 AS INTEGER) END AS contrato, s_suppkey FROM supplier),
b AS (SELECT * FROM a WHERE s_suppkey % 4 = 1)
SELECT abonado, contrato, 'A' AS estatus FROM a WHERE contrato IS NULL OR contrato NOT IN (SELECT contrato FROM b WHERE contrato IS NOT NULL)
UNION ALL SELECT abonado, contrato, 'B' FROM b""")
def pl20(spark, d):
    """Two deliveries: the second replaces its contract dates and adds its undated rows; delivered again it changes nothing."""
    lake = Lake(spark, _scratch(spark))
    first, second = _supplier_books(spark, d), _supplier_books(spark, d, "B", F.col("s_suppkey") % 4 == 1)
    for folder in (first, second, second):
        BZ.churn_risk_bronze(spark, lake, folder + "/*")
    rows = PT.read_table(spark, lake.path("bronze", "Churn_Risk_Raw_Bronze"))
    return rows.select(c("N° Abonado").alias("abonado"), c("Fecha Contrato").alias("contrato"), c("Estatus").alias("estatus"))


@proof("DQ-01", "SELECT 'libros' AS tabla, columna_faltante FROM (VALUES ('Ciudad'), ('Saldo')) v(columna_faltante) WHERE EXISTS (SELECT 1 FROM supplier)")
def dq01(spark, d):
    rows, _ = WB.read_workbooks(spark, _supplier_books(spark, d) + "/*")
    return Q.missing_columns(spark, rows, ["N° Abonado", "Estatus", "Saldo", "Ciudad"], "libros")


@proof("SRC-07", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def src07(spark, d):
    root = _scratch(spark)
    n = Tables(spark, d).nation
    n.toDF(*[f" {c} " for c in n.columns]).write.option("header", True).option("encoding", "ISO-8859-1").csv(root)
    return SF.read_dimension_csv(spark, root)


@proof("SRC-09", "SELECT name FROM (VALUES " + ", ".join(f"('{t}.parquet')" for t in TABLES if t != "embeddings") + ") v(name) WHERE EXISTS (SELECT 1 FROM region)")
def src09(spark, d):
    return SF.list_files(spark, d, pattern="*.parquet", exclude=("embedding",)).select("name")


@proof("SRC-10", "SELECT o_orderkey, 'orders.parquet' AS \"Source.Name\" FROM orders")
def src10(spark, d):
    return SF.with_provenance(Tables(spark, d).orders.select("o_orderkey")).select("o_orderkey", c("Source.Name"))


@proof("SRC-11", """SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS path,
  max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1""")
def src11(spark, d):
    return SF.latest_per_year(Tables(spark, d).orders, "o_orderdate", "o_orderkey").withColumnRenamed("o_orderkey", "path")


@proof("SRC-12", "SELECT arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS path, max(o_orderdate) AS mtime FROM orders")
def src12(spark, d):
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("path"), F.col("o_orderdate").alias("mtime"))
    return SF.latest_file(o)


@proof("SRC-13", """WITH f AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS etiqueta, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes FROM orders),
l AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS etiqueta FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
n AS (SELECT etiqueta FROM f ORDER BY mes DESC, etiqueta DESC LIMIT 1)
SELECT DISTINCT * FROM (SELECT * FROM f WHERE etiqueta NOT IN (SELECT etiqueta FROM l) UNION ALL SELECT * FROM f WHERE etiqueta IN (SELECT etiqueta FROM n))""")
def src13(spark, d):
    o = Tables(spark, d).orders
    files = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("etiqueta"),
                     F.to_date(F.date_trunc("month", "o_orderdate")).alias("mes")).distinct()
    loaded = o.filter(F.col("o_orderdate") < F.lit(dt.datetime(1999, 1, 1))).select(
        F.date_format("o_orderdate", "yyyy-MM").alias("etiqueta"))
    return SF.pending_snapshots(files, loaded, "etiqueta", "mes")


@proof("SRC-15", """SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-21'""")
def src15(spark, d):
    return Tables(spark, d).events.select("event_id", "ts").filter(SF.rolling_window("ts", dt.date(2024, 1, 20), 7))


def _lake(spark):
    from ..sources.lake import Lake
    return Lake(spark, _scratch(spark))


@proof("SNK-01", "SELECT * FROM orders")
def snk01(spark, d):
    lake = _lake(spark)
    lake.save(Tables(spark, d).orders, "gold", "orders")  # snappy
    return lake.read("gold", "orders")


@proof("SNK-02", "SELECT * FROM lineitem")
def snk02(spark, d):
    lake = _lake(spark)
    lake.save(Tables(spark, d).lineitem, "gold", "lineitem", compression="zstd", max_records_per_file=20000)
    return lake.read("gold", "lineitem")


@proof("SNK-03", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def snk03(spark, d):
    lake = _lake(spark)
    lake.save(Tables(spark, d).orders, "silver", "orders")
    current = lake.read("silver", "orders")  # rebuild the table from itself: new version, old one untouched
    lake.save(current.filter(F.col("o_orderstatus") == "F"), "silver", "orders")
    return lake.read("silver", "orders")


@proof("SNK-04", "SELECT * FROM orders WHERE year(o_orderdate) = 1998")
def snk04(spark, d):
    lake = _lake(spark)
    o = Tables(spark, d).orders
    skipped = lake.save(o.filter(F.year("o_orderdate") > 2100), "gold", "future")
    if skipped.get("written") or lake.exists("gold", "future"):
        raise AssertionError("empty table must not be written")
    lake.save(o.filter(F.year("o_orderdate") == 1998), "gold", "y1998")
    return lake.read("gold", "y1998")


@proof("SNK-05", "SELECT * FROM customer")
def snk05(spark, d):
    lake = _lake(spark)
    cu = Tables(spark, d).customer
    for layer in ("bronze", "silver", "gold"):
        lake.save(cu, layer, "customer")
    assert lake.path("gold", "customer").endswith("/gold/customer")
    return lake.read("gold", "customer")


@proof("SNK-06", """SELECT 'por_estado' AS hoja, CAST(o_orderstatus AS VARCHAR) AS clave, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'por_prioridad', CAST(o_orderpriority AS VARCHAR), CAST(count(*) AS VARCHAR) FROM orders GROUP BY 2""")
def snk06(spark, d):
    from ..sources.lake import write_report
    o = Tables(spark, d).orders
    folder = _scratch(spark)
    sheets = {"por_estado": "o_orderstatus", "por_prioridad": "o_orderpriority"}
    write_report({name: o.groupBy(col).agg(F.count(F.lit(1)).alias("n")) for name, col in sheets.items()}, folder, fmt="csv")
    read = [spark.read.option("header", True).csv(f"{folder}/{name}").select(F.lit(name).alias("hoja"), F.col(col).alias("clave"), "n") for name, col in sheets.items()]
    return read[0].unionByName(read[1])


@proof("SNK-07", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders WHERE year(o_orderdate) = 1998")
def snk07(spark, d):
    lake = _lake(spark)
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("anio"))
    lake.save(o, "gold", "orders_by_year", partition_by=["anio"])
    return lake.read("gold", "orders_by_year").filter(F.col("anio") == 1998)  # partition pruning


@proof("DQ-06", "SELECT 'orders' AS tabla, count(*) AS filas FROM orders")
def dq06(spark, d):
    lake = _lake(spark)
    res = lake.save(Tables(spark, d).orders, "gold", "orders")
    return spark.read.parquet(res["path"]).agg(F.lit("orders").alias("tabla"), F.count(F.lit(1)).alias("filas"))


@proof("SRC-08", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 0")
def src08(spark, d):
    t = Tables(spark, d)
    root = _scratch(spark)
    t.nation.filter(F.col("n_regionkey") == 0).agg(F.sort_array(F.collect_list("n_name")).alias("own_offices")) \
        .coalesce(1).write.json(root)
    rules = SF.read_rules(spark, root, {"own_offices": [], "sales_statuses": ["ACTIVO"]})
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.filter(F.col("n_name").isin(*rules["own_offices"])).select("s_suppkey", "n_name")


@proof("SRC-14", """SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS o_orderpriority, DATE '1998-01-01' AS fecha_carpeta, 'antes' AS carpeta
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT o_orderkey, NULL, o_orderpriority, DATE '2001-12-31', 'despues' FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def src14(spark, d):
    o = Tables(spark, d).orders
    root = _scratch(spark)
    cut = F.lit(dt.datetime(1998, 1, 1))
    o.filter(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderstatus").write.parquet(f"{root}/antes")
    o.filter(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderpriority").write.parquet(f"{root}/despues")
    readers = {k: spark.read.parquet(f"{root}/{k}") for k in ("antes", "despues")}
    u = SF.read_folders(readers, "fecha_carpeta", {"antes": dt.date(1998, 1, 1), "despues": dt.date(2001, 12, 31)})
    return u.select("o_orderkey", "o_orderstatus", "o_orderpriority", "fecha_carpeta", F.col("Carpeta").alias("carpeta"))
