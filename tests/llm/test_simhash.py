"""SimHash against a row-by-row version (with Spark's hash), and the block tables against all pairs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import simhash as S


def brute(spark, rows):
    """Rows of the contract, by id; term hashes are Spark's, all else is plain Python."""
    texts = [(i, t or "") for i, t in rows]
    order = sorted(set(texts), key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
    edited = {}
    for k, (i, t) in enumerate(order):
        n = len(t) // 3
        edited[i, t] = t[: len(t) - n] + order[(k + 1) % len(order)][1][:n]
    every = {t for _, t in texts} | set(edited.values())
    terms = {t: pairs(t) for t in every}
    flat = sorted({x for v in terms.values() for x in v}, key=repr)
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(flat)] or [(0, "", "")], "k long, a string, b string")
    hashes = {flat[r.k]: (r.h0, r.h1) for r in df.select("k", F.xxhash64("a", "b").alias("h0")).select("k", "h0", F.xxhash64("h0").alias("h1")).collect() if flat}

    def fingerprint(t):
        out = ""
        for part in (0, 1):
            bits = 0
            for bit in range(64):
                votes = sum(1 if hashes[x][part] >> bit & 1 else -1 for x in terms[t])
                bits |= (votes > 0) << bit
            out += f"{bits:016x}"
        return out

    prints = {t: fingerprint(t) for t in every}
    near = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
    out = []
    for i, t in texts:
        e = edited[i, t]
        after = order[(order.index((i, t)) + 1) % len(order)][1]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), prints[t], prints[e], near(prints[t], prints[e]), near(prints[t], prints[after])))
    return out


def pairs(t):
    w = [x for x in re.split("[ \t\n\x0b\f\r]+", t) if x]
    return list(zip(w, w[1:])) if len(w) > 1 else [(x, None) for x in w]


def fixture():
    r = random.Random(8)
    words = ["the", "of", "dog", "é", "日本", "x"] + [f"w{i}" for i in range(60)]
    texts = [r.choice([" ", "\n", " \t "]).join(r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 9, 50]))) for _ in range(60)]
    rows = list(zip(r.sample(range(-100, 5000), 60), texts))
    return rows + [(6000, None), (6001, ""), (6002, " \n "), (6003, "🙂é🙂"), (6004, texts[4]), (6004, texts[4]), (None, "last one here"), (6005, "lead  \n" * 70000), (6006, " starts with space")]


def test_brute_force(spark):
    rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS k1", "'x' AS version", "2 AS n").repartition(3)
    got = sorted((tuple(x)[:7] for x in S.edited_fingerprints(docs).collect()), key=repr)
    want = sorted(brute(spark, rows), key=repr)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert [x[5:] for x in got] == [pytest.approx(x[5:]) for x in want]


def test_one_document_and_none(spark):
    docs = spark.createDataFrame([(5, "abcdef gh")], "doc_id long, text string")
    (r,) = S.edited_fingerprints(docs).collect()
    assert (r.id, r.n_chars, r.edited_sha256, r.near_next) == (5, 9, hashlib.sha256(b"abcdefabc").hexdigest(), 1.0)
    assert S.edited_fingerprints(docs.limit(0)).collect() == []


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_block_tables_find_all(spark, radius):
    r = random.Random(radius)
    prints = [r.getrandbits(128) for _ in range(40)]
    for p in list(prints):
        for _ in range(6):
            x = p
            for b in r.sample(range(128), r.randrange(0, radius + 3)):
                x ^= 1 << b
            prints.append(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    both = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints]
    df = spark.createDataFrame(both, "high long, low long")
    queries = spark.createDataFrame(both[::5], "high long, low long")
    got = [tuple(x) for x in S.neighbours(queries, df, radius).collect()]
    of = dict(zip(both, prints))
    want = {(*a, *b, d) for a in set(both[::5]) for b in set(both) if 0 < (d := (of[a] ^ of[b]).bit_count()) <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_large_groups_are_counted(spark):
    """More fingerprints under one block value than an array holds; every pair counts once."""
    r = random.Random(2)
    base = r.getrandbits(128)
    prints = sorted({base ^ sum(1 << b for b in r.sample(range(128), r.randrange(0, 12))) for _ in range(2500)})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    both = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints]
    df = spark.createDataFrame(both, "high long, low long")
    got = {(x.high, x.low): x.n for x in S.n_neighbours(df.limit(20), df).collect()}
    of = dict(zip(both, prints))
    asked = [tuple(x) for x in df.limit(20).collect()]
    assert got == {q: n for q in asked if (n := sum(0 < (of[q] ^ p).bit_count() <= S.RADIUS for p in prints))}


def test_planted_near_copies_are_found(spark):
    """Copies with one word in 50 replaced are within the radius, others are not."""
    r = random.Random(6)
    line = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    rows = []
    for i in range(60):
        w = line(r.choice([150, 300, 1000]))
        rows.append((i, " ".join(w)))
        for p in r.sample(range(len(w)), len(w) // 50):
            w[p] = f"new{r.randrange(10**6)}"
        rows.append((100 + i, " ".join(w)))
    prints = {x.doc_id: (x.high, x.low) for x in S.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()}
    df = lambda ids: spark.createDataFrame([prints[i] for i in ids], "high long, low long")
    pairs = {((x.high, x.low), (x.other_high, x.other_low)) for x in S.neighbours(df(range(60)), df(prints)).collect()}
    found = [i for i in range(60) if (prints[i], prints[100 + i]) in pairs or prints[i] == prints[100 + i]]
    assert len(found) >= 54
    assert all((prints[i], prints[j]) not in pairs for i in range(60) for j in prints if j % 100 != i)


def test_the_main_path_is_native(spark):
    plan = S.op6_document_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_on_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = spark.read.parquet(f"{d}/documents.parquet").select("doc_id").join(S.op6_document_fingerprints(spark, d), "doc_id").collect()
    assert len(got) == len(rows)
    want = {x[0]: x for x in brute(spark, rows)}
    for r in got:
        assert tuple(r)[:5] == want[r.doc_id][:5] and (r.near_edited, r.near_next) == pytest.approx(want[r.doc_id][5:])
        assert (r.n_within is None) == (r.doc_id % 50 != 0)
        if r.n_within is not None:
            own = int(r.fingerprint, 16)
            assert r.n_within == sum(0 < (own ^ x).bit_count() <= S.RADIUS for x in {int(w[3], 16) for w in want.values()})
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited for r in long) / len(long) > 0.65 > 0.55 > sum(r.near_next for r in long) / len(long)
