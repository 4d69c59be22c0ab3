"""Publication, streaming and joins lose nothing: replays, crashes, unreadable state, NULL keys."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.operators.joins import map_enrich
from strata.operators.quality import unmapped_values
from strata.operators.resolve import candidate_pairs
from strata.operators.sets import union_distinct
from strata.operators.windows import next_value
from strata.sources.lake import Lake
from strata.sources import partitioned as PT
from strata.sources.partitioned import append_new_rows, read_table, replace_keys
from strata.streaming.ingest import add_distinct, file_stream, keep_latest_stream, newest_by_key, read_latest, replace_dates, run_available_now

SCHEMA = "k int, v string"


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def keys(lake):
    return sorted(r.k for r in lake.read("silver", "t").select("k").collect())


def files_of(folder):
    return {p: p.stat().st_mtime_ns for p in sorted(Path(folder).rglob("*.parquet"))}


def test_newest_rows_in_the_state_store_after_drops_and_restarts(spark, tmp):
    """STR-02: three drops, each a run of its own (restart from the checkpoint), equal the batch window; a batch writes
    only the keys whose newest row has changed."""
    from strata.operators.windows import keep_latest, row_tiebreak

    schema = "k int, t int, v string"
    drops = [[(1, 1, "a"), (2, 5, "b"), (None, 1, "n"), (3, None, "z")], [(1, 2, "c"), (2, 4, "old"), (3, 1, "y"), (4, 1, "q")],
             [(1, 2, "b"), (None, 1, "m"), (4, None, "r"), (5, 9, None)]]
    for n, rows in enumerate(drops):
        put(spark, f"{tmp}/in", rows, schema)
        s = file_stream(spark, f"{tmp}/in", spark.createDataFrame([], schema).schema).select("k", "t", "v")
        keep_latest_stream(s, ["k"], ["t"], f"{tmp}/out", f"{tmp}/ck")
        every = spark.createDataFrame([r for d in drops[:n + 1] for r in d], schema)
        want = sorted(map(tuple, keep_latest(every, ["k"], ["t"], tie_break=row_tiebreak(every)).collect()), key=str)
        assert sorted(map(tuple, read_latest(spark, f"{tmp}/out", ["k"]).collect()), key=str) == want
    written = spark.read.parquet(f"{tmp}/out").groupBy("__batch").agg(F.sort_array(F.collect_list(F.coalesce("k", F.lit(0)))).alias("ks")).orderBy("__batch")
    assert [r.ks for r in written.collect()][0] == [0, 1, 2, 3] and 5 not in [r.ks for r in written.collect()][1]


def test_a_text_order_is_refused(spark):
    with pytest.raises(ValueError, match="newest"):
        newest_by_key(spark.createDataFrame([(1, "a")], SCHEMA), ["k"], ["v"])


def test_a_replayed_stream_batch_changes_nothing(spark, tmp):
    schema = "k int, d date, v string"
    put(spark, f"{tmp}/in", [(1, dt.date(2024, 1, 1), "a"), (2, None, "b")], schema)
    stream = lambda: file_stream(spark, f"{tmp}/in", spark.createDataFrame([], schema).schema).select("k", "d", "v")
    run_available_now(stream(), replace_dates(f"{tmp}/t", "d"), f"{tmp}/ck1")
    run_available_now(stream(), replace_dates(f"{tmp}/t", "d"), f"{tmp}/ck2")  # a fresh checkpoint takes the file again
    assert sorted(map(tuple, read_table(spark, f"{tmp}/t").collect())) == [(1, dt.date(2024, 1, 1), "a"), (2, None, "b")]
    run_available_now(stream(), add_distinct(f"{tmp}/u"), f"{tmp}/ck3")
    run_available_now(stream(), add_distinct(f"{tmp}/u"), f"{tmp}/ck4")
    assert read_table(spark, f"{tmp}/u").count() == 2


def test_untouched_partitions_are_neither_read_nor_written(spark, tmp):
    schema = "k int, d date, v string"
    day = lambda n: dt.date(2024, 1, n)
    replace_keys(spark, f"{tmp}/t", spark.createDataFrame([(n, day(n), "a") for n in range(1, 6)] + [(9, None, "a")], schema), "d")
    untouched = {p: p.read_bytes() for p in files_of(f"{tmp}/t") if "k2024-01-02" not in str(p)}
    for p in untouched:
        p.write_bytes(b"nothing that a reader could read")
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    replace_keys(spark, f"{tmp}/t", spark.createDataFrame([(2, day(2), "b"), (7, day(7), "b")], schema), "d")
    for p, content in untouched.items():
        assert p.read_bytes() == b"nothing that a reader could read"
        p.write_bytes(content)
    assert sorted((r.k, r.v) for r in read_table(spark, f"{tmp}/t").collect()) == [(1, "a"), (2, "b"), (3, "a"), (4, "a"), (5, "a"), (7, "b"), (9, "a")]


def test_undated_rows_and_new_columns(spark, tmp):
    replace_keys(spark, f"{tmp}/t", spark.createDataFrame([(1, "007", "a"), (1, "007", "a"), (2, None, "u")], "k int, label string, v string"), "label")
    more = spark.createDataFrame([(3, "8", "b", 1.5), (2, None, "u", None), (4, None, "w", None)], "k int, label string, v string, x double")
    for _ in range(2):
        replace_keys(spark, f"{tmp}/t", more, "label")
    got = sorted(((r.k, r.label, r.v, r.x) for r in read_table(spark, f"{tmp}/t").collect()), key=str)
    assert got == [(1, "007", "a", None), (2, None, "u", None), (3, "8", "b", 1.5), (4, None, "w", None)]


def test_only_new_rows_are_appended_and_only_hashes_are_read(spark, tmp):
    rows = spark.createDataFrame([(i, f"v{i}", "f1") for i in range(40)] + [(None, None, "f1")], "k int, v string, src string")
    append_new_rows(spark, f"{tmp}/t", rows, ignore_cols=("src",), buckets=8)
    before = files_of(f"{tmp}/t")
    more = spark.createDataFrame([(i, f"v{i}", "f2", None) for i in range(30, 45)] + [(None, None, "f2", None), (1, "v1", "f2", "new")], "k int, v string, src string, x string")
    append_new_rows(spark, f"{tmp}/t", more, ignore_cols=("src",), buckets=8)
    table = read_table(spark, f"{tmp}/t")
    assert table.count() == 41 + 5 + 1 and {p: m for p, m in files_of(f"{tmp}/t").items() if p in before} == before
    assert sorted(r.src for r in table.filter("k = 35 OR k IS NULL").collect()) == ["f1", "f1"]
    plan = PT._hashes(spark, f"{tmp}/t", ["b1"])._jdf.queryExecution().toString()
    assert "= b1)], PushedFilters: []" in plan and "PartitionFilters" in plan and "ReadSchema: struct<__h1:bigint,__h2:bigint>" in plan


def test_unreadable_commit_is_an_error_and_not_a_missing_table(spark, tmp):
    lake = Lake(spark, f"{tmp}/lake")
    assert not lake.exists("silver", "t")
    lake.save(spark.createDataFrame([(1, "a")], SCHEMA), "silver", "t")
    spark.createDataFrame([("no record",)], "v string").write.text(f"{tmp}/lake/silver/t/commits/c=broken")
    with pytest.raises(ValueError):
        lake.exists("silver", "t")


def test_vacuum_keeps_the_current_versions(spark, tmp):
    lake = Lake(spark, f"{tmp}/lake")
    for i in range(4):
        lake.save(spark.createDataFrame([(i, "a")], SCHEMA), "silver", "t")
    assert len(lake.vacuum("silver", "t", keep=2)) == 2
    assert keys(lake) == [3] and lake.vacuum("silver", "t", keep=2) == []


def test_next_value_of_null_keys_crosses_buckets(spark):
    df = spark.createDataFrame([(None, 1), (None, 11), (None, 25), ("a", 2), ("a", 30)], "k string, t int")
    got = next_value(df, ["k"], ["t"], "t", "n", bucket=F.floor(F.col("t") / 10)).collect()
    assert {(r.k, r.t, r.n) for r in got} == {(None, 1, 11), (None, 11, 25), (None, 25, None), ("a", 2, 30), ("a", 30, None)}


def test_dictionary_rows_are_not_mixed_and_null_attributes_get_the_default(spark):
    m = spark.createDataFrame([("x", "b", "1", 1), ("X ", "a", "9", 2), ("y", None, "5", 1)], "k string, p string, q string, o int")
    df = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    cols = {"p": "P", "q": "Q"}
    assert [tuple(r) for r in map_enrich(df, m, "k", "k", cols, order_col="o").orderBy("k").collect()] == [("x", "a", "9"), ("y", "Sin Asignar", "5"), ("z", "Sin Asignar", "Sin Asignar")]
    assert ("x", "b", "1") in [tuple(r) for r in map_enrich(df, m, "k", "k", cols).collect()]


def test_every_unmapped_value_is_listed(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("v"))
    assert unmapped_values(df, "v", spark.createDataFrame([("7",)], "v string"), "v").count() == 39


def test_ignored_columns_come_from_one_row(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, None, 3)], "k int, src string, m int")
    assert sorted(tuple(r) for r in union_distinct(df, ignore_cols=("src", "m")).collect()) == [(1, "a", 2), (2, None, 3)]


@pytest.mark.parametrize("threshold", [50.0, 60.0, 66.7, 80.0, 95.0])
def test_no_candidate_is_lost_at_any_threshold(spark, threshold):
    import random

    from strata.functions.similarity import token_set_ratio

    r = random.Random(int(threshold))
    names = sorted({"".join(r.choice("abcd") for _ in range(r.randrange(1, 8))) for _ in range(60)})
    q = spark.createDataFrame([(x,) for x in names], "q string")
    got = {tuple(x) for x in candidate_pairs(q, q.withColumnRenamed("q", "name"), threshold).collect()}
    assert {(a, b) for a in names for b in names if token_set_ratio(a, b) >= threshold} <= got


def test_null_keys_form_no_recurrence_groups(spark):
    from strata.plans import analytics as AN

    k = AN.TicketCols()
    cols = [k.period_key, k.period, k.contract, k.cause, k.opened, k.ticket, k.solution, k.group]
    rows = [(1, "Q1", con, cause, f"2024-01-{d:02d}", f"{con}{cause}{d}", "s", g)
            for con, cause, g in [("a", "x", "n"), (None, "x", "n"), ("b", None, None)] for d in (1, 5)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {'int' if i == 0 else 'string'}" for i, n in enumerate(cols)))
    df = df.withColumn(k.opened, F.to_timestamp(k.opened)).withColumn("Supervivencia_Dias", F.lit(1.0))
    assert [(r[k.contract], r["Repeticiones"]) for r in AN.recurrence_groups(df, k).collect()] == [("a", 2)]
    assert sorted((r[k.contract], r["Total_Tickets"], r["Viaje_Soluciones"]) for r in AN.friction(df, k).collect()) == [("a", 2, "s"), ("b", 2, "s")]
    rate = AN.repeat_rate(df.withColumn("Siguiente_Apertura", F.lit(None).cast("timestamp")), k, min_tickets=1)
    assert [r[k.group] for r in rate.collect()] == ["n"]
