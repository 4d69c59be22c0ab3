"""Substring dedup over word windows against brute force."""

import hashlib
import random
import re

import pytest

from strata.llm.windows import drop_repeated_windows, op3_substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    """(id, words, removed, kept text) by looking every window up in a dictionary."""
    words = [WORD.findall(t or "") for _, t in rows]
    big = 1 << 62
    first = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - width + 1):
            k = tuple(w[s : s + width])
            first[k] = min(first.get(k, big), big - 1 if i is None else i)
    out = []
    for (i, _), w in zip(rows, words):
        gone, seen = set(), set()
        for s in range(len(w) - width + 1):
            k = tuple(w[s : s + width])
            if first[k] < (big - 1 if i is None else i) or k in seen:
                gone.update(range(s, s + width))
            seen.add(k)
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def fixture(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ß x", "日本"]
    line = lambda n: [r.choice(vocabulary) for _ in range(n)]
    shared = line(30)
    rows = []
    for i in range(60):
        w = line(r.choice([0, 1, 4, 5, 6, 30, 80]))
        if i % 3 == 0:
            w = w + shared[r.randrange(8) : 30 - r.randrange(8)] + line(4)
        if i % 7 == 0:
            w = w + w
        rows.append((i * 3 - 20, r.choice([" ", "\n", " \t "]).join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, " ".join(shared)), (1003, rows[3][1]), (1003, rows[3][1]), (1004, " ".join(line(30000)))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("home_bytes", [300, 1 << 23])
@pytest.mark.parametrize("width", [5, 20])
def test_brute_force(spark, width, home_bytes):
    rows = fixture(width)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = drop_repeated_windows(docs, width=width, home_bytes=home_bytes).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[3])
    assert sorted((tuple(x) for x in got), key=key) == sorted(brute(rows, width), key=key)


def test_carried_columns_and_clashes(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 7, None), (2, None, None, 8, "h")], "id long, t string, home string, n_words int, `ex.tra` string")
    got = drop_repeated_windows(docs, "id", "t", width=2, carry=["home", "n_words", "ex.tra"]).orderBy("id").collect()
    assert [(x.id, x.kept_text, x.extra[0], x.extra[1], x.extra[2]) for x in got] == [(1, "a b c", "x", 7, None), (2, "", None, 8, "h")]


def test_empty_table(spark):
    assert drop_repeated_windows(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, g, hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in brute(rows, 20)}
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in op3_substring_dedup(spark, d).collect()}
    assert got == want
    assert sum(g for _, g, _ in want.values()) > 0
