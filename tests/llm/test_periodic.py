"""Periodic runs: trees against brute force, the query against a plain version of its contract."""

import hashlib
import random
import re
import zlib

import pytest

from strata.llm import periodic as P


def brute(words, least=6, times=4):
    """Each period, each maximal stretch that keeps it, unless a smaller period holds throughout."""
    found = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, times * q) and not any(all(words[k] == words[k + r] for k in range(i, i + size - r)) for r in range(1, q)):
                found.append((i, size, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, k = rng.randint(0, 70), rng.choice([1, 2, 3, 6])
    words = [f"w{rng.randint(1, k)}" for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_trees_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        words = some_words(rng)
        if words:
            assert P.runs_of([words], [0]) == brute(words)


def test_extensions():
    rng = random.Random(6)
    for _ in range(50):
        s = [*[rng.randint(1, 3) for _ in range(rng.randint(2, 40))], 0]
        a, b = zip(*[(i, j) for i in range(len(s)) for j in range(len(s)) if i != j], strict=True)
        got = P.Extensions(s)(P.np.array(a), P.np.array(b)).tolist()
        for i, j, k in zip(a, b, got, strict=True):
            assert s[i : i + k] == s[j : j + k] and s[i + k] != s[j + k]


def expected(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), best and best[0], best and best[1], best and best[2], best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


@pytest.fixture
def rows():
    rng = random.Random(7)
    out = [(i, rng.choice([" ", "\n", " \t"]).join(some_words(rng))) for i in range(300)]
    out += [(None, None), (None, "a b a b a b a b"), (3, ""), (3, " \n "), (-10, "é " * 9), (10**12, "x " * 5), (11, "a b c d e f g " * 400)]
    out += [(500 + i, "the same text " * 3 + "tail " * 7) for i in range(40)]
    return out


def test_query_against_brute_force(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS id", "1 AS runs", "2 AS extra").write.parquet(f"{tmp_path}/documents.parquet")
    out = P.op13_periodic_run_detection(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_operator_keeps_spans_and_columns(spark):
    docs = spark.createDataFrame([(1, "z a b a b a b a b c", "en"), (2, None, None)], "doc_id int, text string, runs string")
    one, none = P.periodic_runs(docs, carry=["runs"]).orderBy("id").collect()
    assert [tuple(r) for r in one["runs"]] == [(1, 8, 2)] and one["collapsed"] == "z a b c" and one["extra"]["c0"] == "en"
    assert none["n_words"] == 0 and none["runs"] == [] and none["collapsed"] == ""


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.digests(P.periodic_runs(P.with_repeated_tails(docs))).collect() == []


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = {r["doc_id"]: tuple(r) for r in P.op13_periodic_run_detection(spark, sf).collect()}
    short = [r for r in rows if len(r[1] or "") < 4000]
    assert len(out) == len(rows) and all(out[r[0]] == expected(*r) for r in short)
