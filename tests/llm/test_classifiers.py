"""Toxicity and quality: held-out accuracy on the given tables, and defined results for odd inputs."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import quality, toxicity
from strata.llm.labels import training_rows
from strata.llm.text import text_buffers

SF = "/root/testdata/sf0.1"


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize("query, label, right", [(toxicity.op1_toxicity, "toxic", 0.95), (quality.op5_quality_classifier, "quality", 0.98)])
def test_held_out_accuracy(spark, query, label, right):
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.held_out == (crc(r.doc_id) % 5 == 0) for r in rows)
    at = 0.5 if label == "toxic" else 0.3
    assert all(r.predicted == int(r.score >= at) for r in rows)
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(truth[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == y for y, _, p in held]) >= right
    rank = lambda k: [s for y, s, _ in held if y == k]
    assert np.mean([a > b for a in rank(1) for b in rank(0)]) > 0.97  # area under the curve


ODD = [(None, "an idiot here"), (1, None), (2, ""), (3, " \n "), (4, "word " * 200000), (4, "Ünï ♥ code"), (4, "Ünï ♥ code"), (5, "!!!! **** ||||")]


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_documents_and_no_labels(spark, module, label):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS label", "2 AS turn")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    for labels in (none, spark.createDataFrame([(None, 1), (3, None)], none.schema)):
        got = module.score_documents(docs, module.fit_model(docs, labels)).collect()
        assert sorted(str(x.id) for x in got) == sorted(str(i) for i, _ in ODD)
        assert {x.score for x in got} == ({0.0} if module is toxicity else {0.5})
    both = spark.createDataFrame([(i, i % 2) for i in range(8)] * 2, none.schema)
    got = module.score_documents(docs, module.fit_model(docs, both)).collect()
    assert len(got) == len(ODD) and all(0 <= x.score <= 1 and not math.isnan(x.score) for x in got)
    assert module.score_documents(docs.limit(0), module.fit_model(docs.limit(0), both)).collect() == []


def test_training_rows_leave_the_held_out_fold_and_keep_the_bound(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)] + [(7, "a"), (8, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i in range(150)] + [(7, 1), (500, 1)], "doc_id long, toxic int")
    got = {r.id: (r.text, r.label) for r in training_rows(docs, labels, "toxic", 1000).collect()}
    assert set(got) == {i for i in range(150) if crc(i) % 5}
    assert got.get(7, ("a", 1)) == ("a", 1)
    assert training_rows(docs, labels, "toxic", 30).count() <= 30


def test_toxicity_features_by_brute_force():
    from strata.llm.text import Roller

    texts = ["The idiot, the IDIOT! x", "", "a", "Ä b-c d"]
    data, offsets = text_buffers(pa.array(texts))
    h, d = toxicity.Features(Roller(toxicity._BASE_WORD))(data, offsets)
    names = {}
    import re

    for i, t in enumerate(texts):
        w = re.findall(r"[0-9a-z\x80-￿]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        want = [(1, x) for x in w] + [(2, *x) for x in zip(w, w[1:])] + [(3, *x) for x in zip(w, w[2:])]
        assert len(set(h[d == i].tolist())) == len(set(want)) and (d == i).sum() == len(want)
        names[i] = set(h[d == i].tolist())
    assert len(names[0] & names[3]) == 0


def test_quality_features_by_brute_force():
    text = "AB ab ab 12|\nline two\nline two\n"
    data, offsets = text_buffers(pa.array(["", text]))
    x = dict(zip(quality.FEATURES, quality.Features()(data, offsets)[1]))
    assert x["log_bytes"] == pytest.approx(math.log1p(len(text)))
    assert x["word_bytes"] == pytest.approx((2 + 2 + 2 + 3 + 4 + 3 + 4 + 3) / 8)
    assert x["words_again"] == pytest.approx(1 / 8)
    assert x["distinct_lines"] == pytest.approx(2 / 3)
    assert x["upper"] == pytest.approx(2 / 20)
    assert x["upper_words"] == pytest.approx(1 / 8)
    assert x["marked_words"] == pytest.approx(1 / 8)
    assert x["marks_0"] == pytest.approx(math.sqrt(1 / len(text)))
    assert not quality.Features()(data, offsets)[0].any()


def test_ftrl_against_a_plain_version():
    """FTRL-proximal, coordinate by coordinate, from its definition: the weight follows from z and n when it is needed."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 25))).astype(np.int32) for _ in range(200)]
    y = np.array([float(rng.random() < (0.8 if 7 in s else 0.2)) for s in sets])
    alpha, beta, l1, l2, prior = 0.7, 1.0, 0.4, 0.05, -0.3
    got = toxicity._weights(sets, y, 60, prior, 3, alpha, beta, l1, l2)
    z, n = [0.0] * 60, [0.0] * 60

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(3):
        for s, label in zip(sets, y, strict=True):
            g = 1 / (1 + math.exp(-(prior + sum(weight(i) for i in s)))) - label
            for i, w in [(i, weight(i)) for i in s]:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w
                n[i] += g * g
    assert got == pytest.approx([weight(i) for i in range(60)]) and 0 < np.count_nonzero(got) < 60


def test_more_weights_than_are_broadcast_raise_the_l1_term():
    texts = [f"bad word{i % 40} thing{i % 30}" if i % 3 == 0 else f"good word{i % 40} other{i % 30}" for i in range(300)]
    table = pa.table({"model": [0] * 300, "turn": list(range(300)), "id": list(range(300)), "text": texts, "label": [int(i % 3 == 0) for i in range(300)]})
    every = toxicity._fit(3, 3.0, 1.0, 0.01, 0.0, 2, 1 << 20)(table)
    few = toxicity._fit(3, 3.0, 1.0, 0.01, 0.0, 2, 20)(table)
    assert len(every) > 21 >= len(few) > 1


def test_bradley_terry_against_gradient_descent():
    """The pairwise logistic loss on feature differences, minimised by plain steps, gives the same weights."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 3)) * [1, 5, 0.2] + [0, 3, 1]
    y = (x @ [1.0, -0.3, 2.0] + rng.normal(size=90) > 0).astype(int)
    table = pa.table({"turn": list(range(90)), "id": list(range(90)), "label": y, "features": x.tolist()})
    model = quality._fit(table)
    w, offset = np.array(model["weights"][0].as_py()), model["offset"][0].as_py()
    std = (x - x.mean(0)) / x.std(0)
    good, bad = np.flatnonzero(y), np.flatnonzero(y == 0)
    n = max(quality.PAIRS * len(bad), len(good), len(bad))
    pairs = [(good[i % len(good)], bad[(i + i // max(len(good), len(bad))) % len(bad)]) for i in range(n)]
    assert {a for a, _ in pairs} == set(good) and {b for _, b in pairs} == set(bad)
    d = np.array([std[a] - std[b] for a, b in pairs])
    v = np.zeros(3)
    for _ in range(20000):
        v += 0.3 * (d.T @ (1 / (1 + np.exp(d @ v))) / n - quality._RIDGE * v)
    assert w * x.std(0) == pytest.approx(v, abs=2e-3)
    # the cut lies at the quantile of the share of label 0
    assert (1 / (1 + np.exp(-(x @ w + offset))) < quality.AT_CUT).sum() == len(bad)
