"""Literal edge rows (FIXTURES §3) for the scalar functions."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import clean as K
from strata.functions import dates as D


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).collect()[0][0]


def test_garbage_to_null(spark):
    for v in ["nan", "NaN", "None", "null", "", "   ", "NAN", "Null"]:
        assert one(spark, K.garbage_to_null, v) is None, v
    assert one(spark, K.garbage_to_null, "Nan") == "Nan"
    assert one(spark, K.garbage_to_null, " a ") == " a "
    assert one(spark, lambda x: K.garbage_to_null(x, trim_values=True), " NoNe ") is None


def test_normalize_id(spark):
    assert one(spark, K.normalize_id, "4473825.0") == "4473825"
    assert one(spark, K.normalize_id, "31.456.789") == "31456789"
    assert one(spark, lambda x: K.normalize_id(x, strip_dots=False), "31.456.789") == "31.456.789"
    assert one(spark, K.normalize_id, "100") == "100"
    assert one(spark, K.normalize_id, " nan ") is None


def test_parse_date_formats(spark):
    for v in ["2024-03-05 10:00:00", "2024-03-05", "05/03/2024 10:00:00", "05/03/2024", "05-03-2024", "5/3/2024"]:
        assert one(spark, D.parse_date, v) == dt.date(2024, 3, 5), v
    assert one(spark, D.parse_date, "31/02/2024") is None
    assert one(spark, D.parse_date, "x") is None


def test_excel_serial(spark):
    assert one(spark, D.parse_mixed, "45356").date() == dt.date(2024, 3, 5)
    assert one(spark, D.parse_mixed, "35000") is None
    assert one(spark, D.parse_mixed, "60000") is None
    assert one(spark, D.parse_mixed, "05/03/2024").date() == dt.date(2024, 3, 5)


def test_hour_bucket(spark):
    cases = {"2:30 p. m.": "14:00", "12:05 a. m.": "00:00", "14:05:00": "14:00", "08:10": "08:00", "xx": None}
    for v, want in cases.items():
        assert one(spark, D.hour_bucket, v) == want, v
    assert one(spark, lambda x: D.hour_bucket(x, default="00:00"), "xx") == "00:00"


def test_minutes_between_clip_and_null(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 9)),
                                (dt.datetime(2024, 1, 1, 10), None)], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(D.minutes_between("b", "a")).collect()]
    assert got == [0.0, None]


def test_round_half_even_matches_numpy(spark):
    import numpy as np

    vals = [2.345, 2.355, 65930.865, 0.125, 1.005, -2.675]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(D.round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]


def test_period_from_name(spark):
    df = spark.createDataFrame([("Data - IdF 1-12-2025 al 15-1-2026.xlsx",), ("Data - IdF 1-12-2025 al 16-1-2026.xlsx",),
                                ("sin rango.xlsx",)], "n string")
    got = D.with_period(df, "n").select("start", "end", "label").collect()
    assert tuple(got[0]) == (dt.datetime(2025, 12, 1), dt.datetime(2026, 1, 15), "ENE 2026 Q1")
    assert got[1][2] == "ENE 2026 Q2"
    assert tuple(got[2]) == (None, None, None)
    col = df.select(D.period_from_name("n").alias("p")).collect()
    assert col[0].p.label == "ENE 2026 Q1" and col[2].p.label is None


def test_snapshot_cut(spark):
    df = spark.createDataFrame([("Abonados 3-1-2026.xlsx",), ("Abonados 20.01.2026.xlsx",), ("Abonados 21/1/2026",)], "n string")
    got = [tuple(r.p) for r in df.select(D.snapshot_cut("n").alias("p")).collect()]
    assert got[0] == (dt.date(2025, 12, 31), "DIC 2025 Q2")
    assert got[1] == (dt.date(2026, 1, 15), "ENE 2026 Q1")


def test_date_token(spark):
    df = spark.createDataFrame([("x 01122025 y",), ("1122025",), ("sin fecha",), ("Empleados 01-12-2025.xlsx",)], "n string")
    got = [r[0] for r in df.select(D.date_token("n")).collect()]
    assert got == [dt.date(2025, 12, 1), dt.date(2025, 2, 11), dt.date(1900, 1, 1), dt.date(2025, 12, 1)]


def test_period_sort_key(spark):
    assert one(spark, D.period_sort_key, "ENE 2026 Q1") == "2026-01-Q1"
    assert one(spark, D.period_sort_key, "XXX 2026 Q1") == "2026-00-Q1"
    assert one(spark, D.period_sort_key, "texto") == "texto"


def test_fold_text(spark):
    assert one(spark, K.fold_text, "  María   PÉREZ-Núñez! ") == "maria pereznunez"


def test_office_after_marker(spark):
    assert one(spark, K.office_after_marker, "Vendedor OFICINA Centro Norte") == "Centro Norte"
    assert one(spark, K.office_after_marker, "sin marca") is None


def test_decimal_comma(spark):
    assert one(spark, K.decimal_comma, "1234,5") == 1234.5
    assert one(spark, K.decimal_comma, "n/a") == 0.0


def test_shape_guard_never_stricter_than_parser(spark):
    import random

    rnd = random.Random(9)
    fmts = D.DEFAULT_DATE_FORMATS + D.HOUR_FORMATS + ["d-M-yyyy", "d/M/yyyy H:mm"]
    texts = []
    for _ in range(300):
        d = dt.datetime(rnd.randint(1990, 2030), rnd.randint(1, 12), rnd.randint(1, 28), rnd.randint(0, 23), rnd.randint(0, 59),
                        rnd.randint(0, 59))
        texts += [d.strftime("%Y-%m-%d %H:%M:%S"), d.strftime("%Y-%m-%d"), f"{d.day}/{d.month}/{d.year}",
                  f"{d.day:02d}/{d.month:02d}/{d.year} {d.hour}:{d.minute:02d}:{d.second:02d}", f"{d.day}-{d.month}-{d.year}",
                  f"{(d.hour % 12) or 12}:{d.minute:02d}{'AM' if d.hour < 12 else 'PM'}", f"{d.hour}:{d.minute:02d}",
                  f"{d.day}/{d.month}/{d.year} {d.hour}:{d.minute:02d}"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for f in fmts:
        raw = F.try_to_timestamp(F.col("x"), F.lit(f))
        guarded = D.try_parse(F.col("x"), f)
        bad = df.filter(raw.isNotNull() & (guarded.isNull() | (guarded != raw))).limit(3).collect()
        assert not bad, (f, bad)
