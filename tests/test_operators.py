"""Operator edge rules (FIXTURES §3) on small literal frames."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import filters as FL
from strata.operators import keys as KY
from strata.operators import merge as M
from strata.operators import windows as W
from strata.operators.joins import map_enrich
from strata.operators.rules import Rule, classify, ticket_rules
from strata.plans import analytics as AN
from strata.plans import tickets as T

D = dt.datetime


def test_backlog_window(spark):
    df = spark.createDataFrame([
        ("closed_in", D(2024, 1, 5), D(2024, 1, 20)),
        ("old_open", D(2023, 12, 1), None),
        ("new_open", D(2024, 1, 3), None),
        ("closed_after", D(2024, 1, 3), D(2024, 2, 3)),
    ], "k string, o timestamp_ntz, cl timestamp_ntz")
    keep = df.filter(FL.period_with_backlog("o", "cl", F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 31)), F.lit(D(2024, 1, 16))))
    assert sorted(r.k for r in keep.collect()) == ["closed_in", "new_open"]


def test_ticket_kpis(spark):
    df = spark.createDataFrame([
        ("never_printed", D(2024, 1, 1, 8), None, D(2024, 1, 1, 10)),
        ("dispatch_gt_res", D(2024, 1, 1, 8), D(2024, 1, 1, 7), D(2024, 1, 1, 9)),
        ("close_before_open", D(2024, 1, 2), None, D(2024, 1, 1)),
        ("open", D(2024, 1, 1, 8), D(2024, 1, 1, 9), None),
    ], "k string, `Fecha Apertura` timestamp_ntz, `Fecha Impresion` timestamp_ntz, `Fecha Cierre` timestamp_ntz")
    out = {r.k: r for r in T.ticket_kpis(df).collect()}
    assert (out["never_printed"][T.RES], out["never_printed"][T.DISP], out["never_printed"][T.PRINT]) == (120.0, 0.0, 120.0)
    assert out["dispatch_gt_res"][T.DISP] == 60.0 and out["dispatch_gt_res"][T.PRINT] == 0.0
    assert out["close_before_open"][T.RES] == 0.0
    assert out["open"][T.RES] is None and out["open"][T.DISP] is None and out["open"][T.PRINT] == 60.0


def test_sla_flags(spark):
    df = spark.createDataFrame([(24 * 60.0, "NOC"), (24 * 60 + 0.6, "NOC"), (0.0, "N/S"), (10.0, "ADMINISTRATIVO")],
                               f"`{T.RES}` double, Clasificacion string").withColumns(
        {"Fecha Apertura": F.lit(None).cast("timestamp_ntz"), "Fecha Cierre": F.lit(None).cast("timestamp_ntz")})
    got = [(r.Cumplio_SLA, r.Es_Falla) for r in T.ticket_flags(df).collect()]
    assert got == [(1, 1), (0, 1), (0, 1), (1, 0)]


def test_ticket_classification_order(spark):
    rules = ticket_rules(admin=["REEMBOLSO"], noc_users=["USR1"], physical=["CABLE"], logical=["RESET"],
                         solution="s", user="u", group="g")
    df = spark.createDataFrame([("REEMBOLSO Y CABLE", "x", "y"), ("CABLE", "USR1", "y"), ("nada", "x", "y"),
                                ("RESET", "x", "OPERACIONES"), ("RESET", "x", "y")], "s string, u string, g string")
    assert [r[0] for r in df.select(classify(rules)).collect()] == ["ADMINISTRATIVO", "NOC", "N/S", "OPERACIONES", "NOC"]


def test_dedupe_prefers_closed_and_keeps_periods(spark):
    df = spark.createDataFrame([("Q1", 1, None), ("Q1", 1, D(2024, 1, 2)), ("Q2", 1, None)],
                               "`Quincena Evaluada` string, `N° Orden` int, `Fecha Cierre` timestamp_ntz")
    got = sorted((r[0], r[2]) for r in T.dedupe_tickets(df).collect())
    assert got == [("Q1", D(2024, 1, 2)), ("Q2", None)]


def test_frequency_rank(spark):
    vals = ["a"] * 5 + ["b"] * 3 + ["c"] * 3 + ["d"] + [None, "  "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {(r.v, r.rk) for r in W.frequency_rank(df, "v", "rk").collect()}
    assert got == {("a", 1), ("b", 2), ("c", 2), ("d", 3), (None, 0), ("  ", 0)}


def test_upsert_by_date(spark):
    hist = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, None)], "id int, d date")
    batch = spark.createDataFrame([(20, dt.date(2024, 1, 2), "x"), (30, dt.date(2024, 1, 3), "y")], "id int, d date, extra string")
    out = M.upsert_by_date(hist, batch, "d")
    assert sorted(r.id for r in out.collect()) == [1, 3, 20, 30]
    assert {r.id: r.extra for r in out.collect()}[1] is None
    strict = M.upsert_by_date(hist, batch, "d", strict_reference=True)
    assert sorted(r.id for r in strict.collect()) == [1, 20, 30]
    b2 = batch.unionByName(spark.createDataFrame([(40, None, "z")], "id int, d date, extra string"))
    once = M.upsert_by_date(hist, b2, "d")
    twice = M.upsert_by_date(once, b2, "d")
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    assert [r.id for r in twice.collect()].count(40) == 1


def test_assign_sk(spark):
    prev = spark.createDataFrame([("A", 7), ("B", 3)], "nk string, sk long")
    cur = spark.createDataFrame([("A",), ("D",), ("C",), (None,), ("  ",)], "nk string")
    got = {r.nk: r.sk for r in KY.assign_sk(cur, prev, "nk", "sk").collect()}
    assert got == {"A": 7, "C": 8, "D": 9}


def test_global_sequence_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = sorted((r.k, r.seq) for r in KY.global_sequence(df, ["k"], "seq", num_partitions=5).collect())
    assert [s for _, s in got] == list(range(1, 1001))
    assert all(k + 1 == s for k, s in got)


def test_validity_intervals(spark):
    df = spark.createDataFrame([("p", dt.date(2024, 1, 1)), ("p", dt.date(2024, 2, 1))], "who string, t date")
    got = sorted(tuple(r) for r in KY.validity_intervals(df, ["who"], "t").select("Fecha_Inicio", "Fecha_Fin", "Estado_Vigencia").collect())
    assert got == [(dt.date(2024, 1, 1), dt.date(2024, 2, 1), "HISTÓRICO"), (dt.date(2024, 2, 1), None, "ACTIVO")]


def test_scd2_collapses_unchanged(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("u", 2, "a"), ("u", 3, "b"), ("u", 4, "a")], "u string, t int, v string")
    got = [(r.v, r.valid_from, r.valid_to) for r in KY.scd2(df, ["u"], "t", ["v"]).orderBy("valid_from").collect()]
    assert got == [("a", 1, 3), ("b", 3, 4), ("a", 4, None)]


def test_unpivot_months(spark):
    df = spark.createDataFrame([("ACTIVO", None, "0", "x", "5"), ("OTRO", "1", "1", "1", "1")],
                               "ESTATUS string, Enero string, Febrero string, Marzo string, Abril string")
    got = [(r.Mes_Nombre, r.Cantidad, r.Fecha) for r in
           KY.unpivot_months(df, ["ESTATUS"], ["Enero", "Febrero", "Marzo", "Abril"], 2024).collect()]
    assert got == [("Abril", 5, dt.date(2024, 4, 1))]


def test_map_enrich_unmapped_keeps_original(spark):
    df = spark.createDataFrame([("Ofi A",), ("Ofi Z",)], "o string")
    m = spark.createDataFrame([(" ofi a ", "OFICINA A", "E1")], "k string, n string, e string")
    got = {r.o: (r.nombre, r.estado) for r in map_enrich(df, m, "o", "k", {"n": "nombre", "e": "estado"},
                                                        fallback_col="nombre").collect()}
    assert got == {"Ofi A": ("OFICINA A", "E1"), "Ofi Z": ("Ofi Z", "Sin Asignar")}


def test_survival_overlap_and_last(spark):
    k = AN.TicketCols(contract="c", cause="x", opened="o", closed="cl", ticket="t")
    df = spark.createDataFrame([("c1", "x", 1, D(2024, 1, 1), D(2024, 1, 10)), ("c1", "x", 2, D(2024, 1, 5), D(2024, 1, 6)),
                                ("c1", "x", 3, D(2024, 1, 8), None)], "c string, x string, t int, o timestamp_ntz, cl timestamp_ntz")
    got = {r.t: r.Supervivencia_Dias for r in AN.survival(df, k).collect()}
    assert got == {1: 0.0, 2: 2.0, 3: None}


def test_route_feeds_wildcards(spark):
    df = spark.createDataFrame([("error", "ALTO"), ("error", "BAJO"), ("view", "ALTO"), ("x", "ALTO"), ("x", "BAJO")], "t string, r string")
    out = FL.route_feeds(df.withColumn("d", F.lit(None).cast("string")),
                         [{"type": "error", "response": "ALTO", "feed": "A"}, {"type": "error", "feed": "B"},
                          {"type": ["view"], "feed": "C"}, {"response": "ALTO", "feed": "D"}], "t", "r", "d")
    assert [r.feed for r in out.collect()] == ["A", "B", "C", "D", None]


def test_rule_combined_all_of(spark):
    r = Rule(None, "contains_any", label="X", all_of=(Rule("a", "contains_any", ("foo",)), Rule("b", "in", ("BAR",))))
    df = spark.createDataFrame([("xfoo", "bar"), ("xfoo", "baz")], "a string, b string")
    assert [x[0] for x in df.select(classify([r], "N")).collect()] == ["X", "N"]


def test_normality_and_bootstrap(spark):
    import numpy as np

    from strata.operators.stats import bootstrap_mean, normality_test

    rng = np.random.default_rng(42)
    vals = rng.normal(12, 2, 3000).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    nt = normality_test(df, "v").collect()[0]
    assert nt.p_value > 0.05 and nt.es_normal
    skewed = spark.createDataFrame([(i, float(np.exp(v / 3))) for i, v in enumerate(vals)], "id long, v double")
    assert normality_test(skewed, "v").collect()[0].p_value < 0.05
    b = bootstrap_mean(df, "v", replicates=400).collect()[0]
    boot = [rng.choice(vals, len(vals)).mean() for _ in range(400)]
    lo, hi = np.percentile(boot, [2.5, 97.5])
    assert abs(b.media_bootstrap - np.mean(vals)) < 0.05
    assert abs(b.ic_inferior - lo) < 0.06 and abs(b.ic_superior - hi) < 0.06
    assert b.replicas == 400


def test_bucketed_lead_equals_plain_lead(spark):
    import random

    rnd = random.Random(3)
    data = [(rnd.choice(["hot"] * 8 + ["a", "b"]), rnd.randint(0, 400), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, t int, i int")
    plain = W.next_value(df, ["k"], ["t", "i"], "i", "nx")
    bucketed = W.next_value(df, ["k"], ["t", "i"], "i", "nx", bucket=(F.col("t") / 37).cast("int"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, bucketed.collect()))


def test_conform_matches_case_insensitively(spark):
    from strata.operators.shape import conform
    df = spark.createDataFrame([("1", "x")], "Id string, extra string")
    out = conform(df, ["ID", "Estatus"])
    assert out.columns == ["ID", "Estatus"] and [tuple(r) for r in out.collect()] == [("1", None)]
