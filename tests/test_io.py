"""Sources, sinks, streaming ingestion (files in pytest temp folders)."""

import datetime as dt
import os
import time
import zipfile

from pyspark.sql import functions as F

from strata.sources import files as SF
from strata.sources import partitioned as PT
from strata.sources import workbook as WB
from strata.sources.lake import Lake, write_report
from strata.streaming import ingest as SI


def make_xlsx(path, rows):
    """Minimal workbook with inline strings (no external writer needed)."""
    def cell(ref, v):
        return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if v is not None else ""
    xml_rows = []
    for i, r in enumerate(rows, start=1):
        cells = "".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(r))
        xml_rows.append(f'<row r="{i}">{cells}</row>')
    sheet = ('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
             f'<sheetData>{"".join(xml_rows)}</sheetData></worksheet>')
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("[Content_Types].xml", "<Types/>")


def test_xlsx_folder_drifting_headers(spark, tmp):
    make_xlsx(f"{tmp}/Data - A 1-1-2024 al 15-1-2024.xlsx", [["N° Abonado", "Fecha"], ["1", "05/01/2024"], ["2", None]])
    make_xlsx(f"{tmp}/Data - B 16-1-2024 al 31-1-2024.xlsx", [["N° Abonado", "Banco", ""], ["3", "X", "junk"]])
    make_xlsx(f"{tmp}/~$lock.xlsx", [["a"], ["b"]])
    with open(f"{tmp}/roto.xlsx", "wb") as f:
        f.write(b"not a zip")
    rows, errors = WB.read_workbooks(spark, tmp)
    got = sorted((r["N° Abonado"], r["Fecha"], r["Banco"]) for r in rows.collect())
    assert got == [("1", "05/01/2024", None), ("2", None, None), ("3", None, "X")]
    assert "Col_2" not in rows.columns and "Source.Name" in rows.columns
    assert [r.source_name for r in errors.collect()] == ["roto.xlsx"]


def test_html_tables(spark):
    html = ("<html><table><tr><th>Nombre</th><th></th><th>Nombre</th></tr><tr><td>a</td><td>b</td><td>c</td><td>extra</td></tr>"
            "<tr><td> </td></tr><tr><td>d</td></tr></table></html>")
    df = spark.createDataFrame([("f.xls", html)], "name string, body string")
    long = WB.html_tables(df, "name", "body")
    wide = WB.promote_header(long)
    assert sorted(wide.columns) == sorted(["Nombre", "Nombre_2", "Source.Name"])
    assert sorted((r.Nombre, r.Nombre_2) for r in wide.collect()) == [("a", "c"), ("d", None)]


def test_latin1_csv_and_rules(spark, tmp):
    with open(f"{tmp}/dim.csv", "wb") as f:
        f.write(" Input_Original ,Estado\nOfi Peña,Mérida\n".encode("latin-1"))
    d = SF.read_dimension_csv(spark, f"{tmp}/dim.csv")
    assert d.columns == ["Input_Original", "Estado"] and d.collect()[0].Estado == "Mérida"
    SF.write_rules(f"{tmp}/r.json", {"own_offices": ["A", "B"]})
    rules = SF.read_rules(spark, f"{tmp}/r.json", {"own_offices": [], "sales_statuses": ["ACTIVO"]})
    assert rules == {"own_offices": ["A", "B"], "sales_statuses": ["ACTIVO"]}


def test_file_listing_and_folders(spark, tmp):
    for n in ["a.xlsx", "Consolidado.xlsx", "~$b.xlsx", "c.csv"]:
        with open(f"{tmp}/{n}", "w") as f:
            f.write("x")
    names = sorted(r.name for r in SF.list_files(spark, tmp, exclude=("Consolidado",)).collect())
    assert names == ["a.xlsx"]
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, z string")
    u = SF.read_folders({"f1": a, "f2": b}, "Fecha", {"f1": dt.date(2024, 1, 1)})
    assert sorted((r.x, r.Fecha, r.z) for r in u.collect()) == [(1, dt.date(2024, 1, 1), None), (2, None, "y")]


def test_lake_save_versions_and_safe_replace(spark, tmp):
    lake = Lake(spark, tmp)
    df = spark.range(5).withColumn("p", F.col("id") % 2)
    r1 = lake.save(df, "silver", "t", audit=True)
    assert r1["rows"] == 5
    cur = lake.read("silver", "t")
    r2 = lake.save(cur.filter("id > 1"), "silver", "t", compression="zstd", partition_by=["p"], audit=True)  # rebuild from itself
    assert r2["rows"] == 3 and r1["version"] != r2["version"]
    assert sorted(r.id for r in lake.read("silver", "t").filter("p = 1").collect()) == [3]
    assert lake.save(df.limit(0), "gold", "empty") == {"table": "empty", "written": False, "reason": "empty"}
    paths = write_report({"a": df, "b": df.limit(1)}, f"{tmp}/report", fmt="csv")
    assert all(os.path.isdir(p) for p in paths)


def test_streaming_only_new_files(spark, tmp):
    src, table = f"{tmp}/in", f"{tmp}/table"
    os.makedirs(src)
    schema = "id int, dia date, v string"
    spark.createDataFrame([(1, dt.date(2024, 1, 1), "a"), (2, dt.date(2024, 1, 2), "b")], schema).coalesce(1).write.parquet(f"{src}/d1")
    stream = lambda: SI.file_stream(spark, src, spark.createDataFrame([], schema).schema,
                                    options={"recursiveFileLookup": "true"})
    SI.run_available_now(stream(), SI.replace_dates(table, "dia"), f"{tmp}/ckpt")
    first = sorted((r.id, r.v) for r in PT.read_table(spark, table).collect())
    time.sleep(1)
    spark.createDataFrame([(3, dt.date(2024, 1, 2), "c")], schema).coalesce(1).write.parquet(f"{src}/d2")
    SI.run_available_now(stream(), SI.replace_dates(table, "dia"), f"{tmp}/ckpt")
    second = sorted((r.id, r.v) for r in PT.read_table(spark, table).collect())
    assert first == [(1, "a"), (2, "b")]
    assert second == [(1, "a"), (3, "c")]  # day 2 replaced by the new file only


def test_missing_columns_alert(spark):
    from strata.operators.quality import missing_columns
    df = spark.createDataFrame([(1, "x")], "`N° Abonado` int, Estatus string")
    got = [r.columna_faltante for r in missing_columns(spark, df, ["N° Abonado", "Estatus", "Saldo", "Ciudad"], "t").collect()]
    assert got == ["Saldo", "Ciudad"]


def test_bronze_ingestion_replace_by_date(spark, tmp):
    from strata.plans.bronze import ingest
    raw = f"{tmp}/raw"
    os.makedirs(raw)
    lake = Lake(spark, f"{tmp}/lake")
    make_xlsx(f"{raw}/Data_Churn_Risk 1.xlsx", [["N° Abonado", "Fecha Contrato", "Estatus"], ["1", "01/01/2024", "A"],
                                                  ["2", "02/01/2024", "A"], ["3", "sin fecha", "A"]])
    r1 = ingest(spark, lake, raw, "churn", "Fecha Contrato", expected=["Estatus", "Saldo"])
    assert r1["rows"] == 3 and r1["missing_columns"] == ["Saldo"]
    make_xlsx(f"{raw}/Data_Churn_Risk 2.xlsx", [["N° Abonado", "Fecha Contrato", "Estatus"], ["2", "02/01/2024", "B"]])
    os.remove(f"{raw}/Data_Churn_Risk 1.xlsx")
    with open(f"{raw}/roto.xlsx", "wb") as f:
        f.write(b"zzz")
    r2 = ingest(spark, lake, raw, "churn", "Fecha Contrato")
    got = sorted((r["N° Abonado"], r["Estatus"]) for r in PT.read_table(spark, lake.path("bronze", "churn")).collect())
    assert got == [("1", "A"), ("2", "B"), ("3", "A")]
    assert r2["unreadable_files"] == ["roto.xlsx"]


def test_workbooks_of_equal_names_repeated_headers_and_dates(spark, tmp):
    from strata.proofs.books import workbook

    assert WB.header_names(["a", "a", "a_1", None, "A", "a_2"]) == ["a", "a_1", "a_1_2", "Col_3", "A_4", "a_2"]
    for folder, rows in (("x", [["1", 45292.0], ["2", 45292.5]]), ("y", [["3", 0.25]])):
        os.makedirs(f"{tmp}/{folder}")
        with open(f"{tmp}/{folder}/libro.xlsx", "wb") as f:
            f.write(workbook(["N", "Fecha", "Fecha", "Fecha_2"], [[n, ("date", s), ("date", s), s] for n, s in rows]))
    rows, errors = WB.read_workbooks(spark, f"{tmp}/*")
    got = sorted((r["N"], r["Fecha"], r["Fecha_2"], r["Fecha_2_3"]) for r in rows.collect())
    assert got == [("1", "2024-01-01", "2024-01-01", "45292.0"), ("2", "2024-01-01 12:00:00", "2024-01-01 12:00:00", "45292.5"), ("3", "06:00:00", "06:00:00", "0.25")]
    assert errors.count() == 0


def test_only_files_with_a_lock_prefix_are_left_out(spark, tmp):
    for n in ("Resumen 2024.xlsx", "Consolidado.xlsx", "a~$b.xlsx", "~$c.xlsx"):
        with open(f"{tmp}/{n}", "wb") as f:
            f.write(b"x")
    assert sorted(r.name for r in SF.list_files(spark, tmp).collect()) == ["Consolidado.xlsx", "Resumen 2024.xlsx", "a~$b.xlsx"]
    assert sorted(r.name for r in SF.list_files(spark, tmp, exclude=("consolidado",)).collect()) == ["Resumen 2024.xlsx", "a~$b.xlsx"]
