"""Language ID: held-out accuracy, and word scores against a plain dictionary version."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import language as G

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = G.op7_language_id(spark, SF).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.97
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"}


def words(text):
    out, now = [], ""
    for c in text + " ":
        if c.isalpha():
            now += c.lower() if len(c.lower()) == 1 else c
        elif now:
            out.append(now)
            now = ""
    return out


def brute(rows, tests):
    langs = sorted({x for _, _, x in rows})
    tables = {}
    for n in range(G.LONGEST + 1):
        count = {}
        for _, text, lang in rows:
            for w in words(text):
                line = f"\0{w}\0"
                for g in [w] if n == 0 else [line[i : i + n] for i in range(len(line) - n + 1)]:
                    count.setdefault(g, Counter())[lang] += 1
        if n == 0:
            count = {k: v for k, v in count.items() if sum(v.values()) > 1}
        total = {x: sum(v[x] + 0.5 for v in count.values()) for x in langs}
        tables[n] = {k: [math.log((v[x] + 0.5) / total[x]) for x in langs] for k, v in count.items()}

    def score(w):
        if w in tables[0]:
            return tables[0][w]
        line = f"\0{w}\0"
        for n in range(G.LONGEST, 0, -1):
            hits = [tables[n][g] for i in range(len(line) - n + 1) if (g := line[i : i + n]) in tables[n]]
            if hits:
                return [sum(x) / len(hits) for x in zip(*hits)]
        return [0.0] * len(langs)

    out = []
    for text in tests:
        w = words(text or "")
        if not w:
            out.append(("und", 0.0))
            continue
        total = [sum(x) for x in zip(*map(score, w))]
        best = max(range(len(langs)), key=lambda k: total[k])
        sure = [t / len(w) * min(len(w), G.SURE) for t in total]
        out.append((langs[best], 1 / sum(math.exp(s - sure[best]) for s in sure)))
    return out


TESTS = [None, "", "12 !? \n", "the dog", "Der HUND", "xyz", "é", "ÅNGSTRÖM \U0001d49c", "thequickx theq", "la la LA", "der the", "日本 w" * 3, "und " * 50000]


def test_brute_force(spark):
    rows = [(i, t, x) for i, (t, x) in enumerate([("the quick brown fox the", "en"), ("der schnelle Hund der Ärger", "de"), ("la vie en rose, là-bas la", "fr"), ("the the of and", "en"), ("und der die das und", "de")] * 3) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows += [(100, None, "en"), (101, "ignored words here", None), (None, "das das dort", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS label", "1 AS n")
    model = G.fit_model(docs)
    tests = spark.createDataFrame(list(enumerate(TESTS)) + [(None, "der"), (0, "the")], "doc_id long, text string").selectExpr("*", "'de' AS lang", "2.0 AS score")
    got = [(r.id, r.lang_pred, r.score) for r in G.identify(tests, model).collect()]
    want = brute([r for r in rows if r[1] and r[2]], [*TESTS, "der", "the"])
    assert len(got) == len(want)
    for (i, lang, score), (w_lang, w_score) in zip(got, want):
        assert lang == w_lang and score == pytest.approx(w_score, abs=1e-5), i


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in G.identify(docs, G.fit_model(docs)).collect()] == [(1, "und", 0.0)]
    assert G.identify(docs.limit(0), G.fit_model(docs.limit(0))).collect() == []


def test_the_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = G.fit_model(docs, sample=50)
    assert set(model.langs) <= {"en", "de", "fr", "es"} and len(model.tables[0][0]) < len(G.fit_model(docs).tables[0][0])
