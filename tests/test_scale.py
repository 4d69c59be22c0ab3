"""Steps whose time or memory once grew faster than their input."""

import datetime as dt
import random

import numpy as np

from strata.functions.similarity import token_set_ratio
from strata.llm import quality
from strata.llm.labels import training_rows
from strata.operators import filters as FL
from strata.operators import resolve as R
from strata.plans import calls as CL
from strata.plans import tickets as T
from strata.sources import workbook as WB
from strata.proofs.tickets import JOB_RULES

from .conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _ticket(name, order, opened, closed):
    return (name, order, "7", "CERRADA", opened, None, closed, "ECONOMY", "1-URGENT", "F", "Brand#1")


TICKET = ["Source.Name", "N° Orden", "N° Contrato", "Estatus_orden", "Fecha Creacion", "Fecha Impresion", "Fecha Finalizacion",
          "Solucion Aplicada", "Grupo Trabajo", "Franquicia", "Detalle Orden"]


def test_tickets_are_not_dealt_by_file_and_dates_are_parsed_once(spark):
    book = "Data - Ordenes 1-1-1997 al 15-6-1998.xlsx"
    bronze = spark.createDataFrame([
        _ticket(book, "1.0", "02/06/1998 08:00:00", "03/06/1998 09:30:00"),
        _ticket(book, "2", "35948.0", "35949.0"),  # 2 and 3 June 1998
        _ticket(book, "3", "35948.0", None),
        _ticket(book, "4", "no date", "neither"),
        _ticket("without a period.xlsx", "5", "02/06/1998 08:00:00", "03/06/1998 09:30:00"),
        _ticket("from 1-13-1997 to 40-6-1998.xlsx", "6", "02/06/1998 08:00:00", None)], ", ".join(f"`{n}` string" for n in TICKET))
    silver = T.build_silver(bronze, JOB_RULES)
    assert sorted(rows(silver, "N° Orden", "Fecha Apertura", T.RES), key=str) == sorted([
        ("1", *rows(spark.sql("SELECT TIMESTAMP_NTZ '1998-06-02 08:00:00'"))[0], 1530.0),
        ("2", *rows(spark.sql("SELECT TIMESTAMP_NTZ '1998-06-02 00:00:00'"))[0], 1440.0),
        ("3", *rows(spark.sql("SELECT TIMESTAMP_NTZ '1998-06-02 00:00:00'"))[0], None)], key=str)
    lines = plan(silver).splitlines()
    join = next(x for x in lines if "__src" in x and "Join" in x)
    assert "BroadcastHashJoin" in join and "gettimestamp" not in join and "try_cast" not in join
    # a file name is parsed once for the file: not in a filter of the rows
    assert not [x for x in lines if "Filter" in x and "regexp" in x]


def _numbered(spark, n):
    """Master names that differ in the number's last digits only, and the same with a letter less, more or a space less."""
    names = [f"supplier {i:09d}" for i in range(0, 3 * n, 3)]
    asked = [(x.replace("supplier", "suplier"), x[:-1], x + "7", x.replace(" ", ""), x.replace("0 ", "0"), x[:13] + " " + x[13:])[i % 6] for i, x in enumerate(names)]
    return [*names[::4], *asked], names


def test_candidates_of_numbered_names_are_complete_and_grow_linearly(spark):
    def pairs(qs, ms):
        return {(r.q, r.name) for r in R.candidate_pairs(spark.createDataFrame([(q,) for q in qs], "q string"), spark.createDataFrame([(m,) for m in ms], "name string")).collect()}

    got = {}
    for n in (60, 240):
        qs, ms = _numbered(spark, n)
        qs = sorted(set(qs))
        got[n] = pairs(qs, ms)
        want = {(q, m) for q in qs for m in ms if token_set_ratio(q, m) >= 95.0}
        assert want and want <= got[n]
    assert len(got[240]) <= 5 * len(got[60]) and len(got[240]) < 240 * 12


def test_candidates_of_short_names_are_complete(spark):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("ab") for _ in range(n))
    ms = sorted({" ".join(word(rnd.randint(1, 7)) for _ in range(rnd.randint(1, 4))) for _ in range(150)})
    qs = sorted({q for m in ms for q in (m[1:].strip(), m + "b", m.replace(" ", "", 1), m[:4] + " " + m[4:], m[:3] + m[2:])} - {""})
    got = {(r.q, r.name) for r in R.candidate_pairs(spark.createDataFrame([(q,) for q in qs], "q string"), spark.createDataFrame([(m,) for m in ms], "name string")).collect()}
    assert {(q, m) for q in qs for m in ms if token_set_ratio(q, m) >= 95.0} <= got


def test_html_rows_are_handed_on_in_batches(spark, monkeypatch):
    row = "<tr><td>a &amp; b {i}</td><td>\n {i},5 </td></tr>"
    text = "<html><!-- <tr><td>no</td></tr> --><table><tr><th>N</th><th>V</th></tr>" + "".join(row.format(i=i) for i in range(9000)) + "</table>"
    whole = WB._TableParser()
    whole.feed(text)
    sizes, one = [], WB._TableParser.handle_endtag

    def watched(self, tag):
        one(self, tag)
        sizes.append(len(self.rows))
    monkeypatch.setattr(WB._TableParser, "handle_endtag", watched)
    assert WB.html_table_rows(text) == whole.rows and max(sizes) < 3000
    monkeypatch.undo()
    df = spark.createDataFrame([("f", text), ("g", None), ("h", text[:200])], "n string, b string").coalesce(1)
    got = WB.html_tables(df, "n", "b").collect()
    assert [(r.row_no, r.cells) for r in got if r.source_name == "f"] == list(enumerate(whole.rows))
    assert {r.source_name for r in got} == {"f", "h"}


def _some_labels(spark, n, bad):
    rnd = random.Random(n)
    rows = [(i, " ".join(rnd.choice(["word", "other!", "A1", "|x|"][: 2 if bad(i) else 4]) for _ in range(rnd.randint(1, 40))), int(not bad(i))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "quality")


def test_quality_model_is_fitted_on_all_labelled_documents_in_groups(spark, monkeypatch):
    docs, labels = _some_labels(spark, 900, lambda i: i % 3 == 0)
    seen, one = [], quality._solve

    def watched(over):
        seen.append(np.array(over("moments")))
        return one(over)
    monkeypatch.setattr(quality, "_solve", watched)
    whole, dealt = quality.fit_model(docs, labels), quality.fit_model(docs, labels, group=60)
    held = training_rows(docs, labels, "quality", 10_000).count()
    assert [len(s) for s in seen] == [1, -(-held // 60)] and all(s[:, 0].sum() == held for s in seen)
    monkeypatch.setattr(quality, "_READ", 3)  # the cut by narrowing
    monkeypatch.setattr(quality, "_PARTS", 4)
    assert quality.fit_model(docs, labels, group=60) == dealt
    scores = [{r.id: r.score for r in quality.score_documents(docs, m).collect()} for m in (whole, dealt)]
    low = [{i for i, s in x.items() if s < quality.AT_CUT} for x in scores]
    assert len(low[0] ^ low[1]) <= 30
    # in both, the training documents below the cut are as many as those labelled 0
    train = {r.id: r.label for r in training_rows(docs, labels, "quality", 10_000).collect()}
    assert all(abs(sum(i in x for i in train) - sum(v == 0 for v in train.values())) <= 2 for x in low)


def test_quality_class_too_small_for_every_group_is_in_all_pairs(spark):
    docs, labels = _some_labels(spark, 400, lambda i: i in (7, 8, 9, 10, 11))
    weights, offset = quality.fit_model(docs, labels, group=50)
    assert any(weights) and np.isfinite(offset)


def test_win_back_filter_parses_the_date_once(spark):
    """Each mention of the date in the filter is one more parse of its text, in code too large to be compiled."""
    bronze = spark.createDataFrame([("1", d, "08:10") for d in ["01/02/2024", "04/02/2024", "x", None]], "`N° Abonado` string, `Fecha Llamada` string, `Hora Llamada` string")
    out = CL.win_back(bronze, dt.date(2024, 2, 1))
    filters = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "2024-02-03" in x]
    assert len(filters) == 1 and filters[0].lower().count("gettimestamp") == len(CL.DAY_FIRST)
    assert sorted(str(r["Fecha"])[:10] for r in out.collect()) == ["2024-02-01", "None"]


def test_date_window_of_missing_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1),), (dt.date(2024, 2, 9),), (None,)], "d date")
    got = df.select(FL.date_window("d", as_of=dt.date(2024, 2, 1)).alias("x"), FL.date_window("d", as_of=dt.date(2024, 2, 1), keep_undated=True).alias("y")).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (False, True)]
