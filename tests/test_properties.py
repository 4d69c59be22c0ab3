"""SURVEY §5 properties on random small inputs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import keys as KY
from strata.operators import merge as M
from strata.operators import windows as W


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_append_distinct_commutative(spark):
    rnd = random.Random(1)
    a = spark.createDataFrame([(rnd.randint(0, 20), rnd.choice("xyz")) for _ in range(60)], "k int, v string")
    b = spark.createDataFrame([(rnd.randint(10, 30), rnd.choice("xyz")) for _ in range(60)], "k int, v string")
    assert _rows(M.append_distinct(a, b)) == _rows(M.append_distinct(b, a))
    assert _rows(M.append_distinct(M.append_distinct(a, b), b)) == _rows(M.append_distinct(a, b))


def test_assign_sk_stable_and_never_reused(spark):
    rnd = random.Random(2)
    prev_keys = rnd.sample(range(1000), 80)
    prev = spark.createDataFrame([(f"k{k:04d}", i * 3 + 1) for i, k in enumerate(prev_keys)], "nk string, sk long")
    cur_keys = rnd.sample(range(1000), 120)
    cur = spark.createDataFrame([(f"k{k:04d}",) for k in cur_keys], "nk string")
    out = {r.nk: r.sk for r in KY.assign_sk(cur, prev, "nk", "sk").collect()}
    old = {r.nk: r.sk for r in prev.collect()}
    for k, v in out.items():
        if k in old:
            assert v == old[k]
    new_sks = [v for k, v in out.items() if k not in old]
    assert len(set(out.values())) == len(out)
    assert min(new_sks) > max(old.values())
    assert sorted(new_sks) == list(range(max(old.values()) + 1, max(old.values()) + 1 + len(new_sks)))
    new_in_key_order = [out[k] for k in sorted(k for k in out if k not in old)]
    assert new_in_key_order == sorted(new_in_key_order)


def test_validity_intervals_do_not_overlap(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", "c"]), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 90)), i) for i in range(200)]
    df = spark.createDataFrame(data, "who string, d date, i int").dropDuplicates(["who", "d"])
    out = KY.validity_intervals(df, ["who"], "d", "ini", "fin", "estado").collect()
    by = {}
    for r in out:
        by.setdefault(r.who, []).append((r.ini, r.fin))
    for spans in by.values():
        spans.sort()
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert e1 == s2 and s1 < e1
        assert spans[-1][1] is None
        assert sum(1 for _, e in spans if e is None) == 1


def test_keep_latest_one_row_per_key(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["h"] * 5 + ["x", "y", None]), rnd.randint(0, 50), rnd.random()) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, t int, v double")
    out = W.keep_latest(df, ["k"], ["t"], tie_break=W.row_tiebreak(df))
    keys = [r.k for r in out.collect()]
    assert len(keys) == len(set(keys)) == df.select("k").distinct().count()
    best = {r.k: r.t for r in df.groupBy("k").agg(F.max("t").alias("t")).collect()}
    assert {r.k: r.t for r in out.collect()} == best
