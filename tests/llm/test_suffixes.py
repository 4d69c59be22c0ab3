"""Suffix-array dedup of byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from strata.llm.suffixes import drop_shared_strings, op2_suffix_array_dedup, triggers

BIG = 1 << 62


def brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    least = {}
    for (i, _), t in zip(rows, texts):
        for s in range(len(t) - width + 1):
            k = t[s : s + width]
            least[k] = min(least.get(k, BIG), BIG if i is None else i)
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - width + 1):
            if least[t[s : s + width]] < (BIG if i is None else i):
                gone[s : s + width] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(t) else 0
        out.append((i, len(t), int(gone[:-1].sum()), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def fixture(seed, width):
    r = random.Random(seed)
    line = lambda n: "".join(r.choice("abcdeé \n日") for _ in range(n))
    shared = [line(r.randrange(width - 3, 4 * width)) for _ in range(6)]
    rows = []
    for i in range(70):
        t = line(r.choice([0, 1, width // 2, width, 3 * width]))
        for _ in range(r.randrange(3)):
            s = r.choice(shared)
            a = r.randrange(len(s) // 2)
            t += s[a : a + r.randrange(width // 2, len(s))] + line(r.choice([0, 1, 7]))
        rows.append((i * 2 - 30, t))
    rows += [(900, None), (901, ""), (902, rows[5][1]), (902, rows[5][1]), (None, shared[0] * 2), (903, "ab" * 300), (904, "ab" * 200), (905, "z" * 500), (906, "z" * 300), (907, line(20000) + shared[2])]
    rows.append((908, rows[9][1] + "!" + rows[3][1]))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("home_bytes", [400, 1 << 23])
@pytest.mark.parametrize("width, trigger", [(12, 5), (50, 20)])
def test_brute_force(spark, width, trigger, home_bytes):
    rows = fixture(width, width)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(*x[:4], bytes(x[4])) for x in drop_shared_strings(docs, width=width, trigger=trigger, home_bytes=home_bytes).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[4])
    assert sorted(got, key=key) == sorted(brute(rows, width), key=key)


def test_triggers():
    r = np.random.default_rng(0)
    for n, span in [(40, 1), (40, 7), (40, 31), (40, 40), (64, 32)]:
        h = r.integers(0, 5, n).astype(np.uint64) << np.uint64(40)
        assert triggers(h, span).tolist() == [i + int(h[i : i + span].argmin()) for i in range(n - span + 1)]


def test_empty_table_and_carried_columns(spark):
    assert drop_shared_strings(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.createDataFrame([(1, "x" * 80, "u"), (2, "x" * 60, None)], "doc_id long, text string, kept string")
    got = drop_shared_strings(docs, carry=["kept"]).orderBy("id").collect()
    assert [(bytes(x.kept), x.extra[0]) for x in got] == [(b"x" * 80, "u"), (b"", None)]


def test_query_on_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, g, s, hashlib.sha256(t).hexdigest()) for i, n, g, s, t in brute(rows, 50)}
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in op2_suffix_array_dedup(spark, d).collect()} == want
    assert sum(g for _, g, _, _ in want.values()) > 0


def test_long_texts_are_taken_in_stretches(monkeypatch):
    """Triggers beyond the places that a sort key holds: the same as run by run."""
    import numpy as np

    from strata.llm import suffixes as S

    monkeypatch.setattr(S, "_PLACE_BITS", 6)
    rng = np.random.default_rng(2)
    for n in (3, 31, 32, 33, 63, 64, 65, 500, 1000):
        for span in (1, 3, 31):
            h = rng.integers(0, 2**10, n).astype(np.uint64) << np.uint64(6)
            want = [a + int(np.argmin(h[a : a + span])) for a in range(max(0, n - span + 1))]
            if want:
                assert S.triggers(h, span).tolist() == want
