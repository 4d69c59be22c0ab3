"""Benchmark decontamination against the exact smallest word-edit distance to any stretch."""

import random
import re

import numpy as np
import pytest

from strata.llm import decontaminate as D

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def least_edits(item, text):
    """Sellers' recurrence: the fewest edits between the item and any stretch of the text."""
    cost = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(cost[j] + (w != x), cost[j + 1] + 1, new[j] + 1))
        cost = new
    return min(cost)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    new = [i + 1]
    for j, y in enumerate(b):
        new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
    return new


def test_best_stretch():
    r = random.Random(1)
    for _ in range(400):
        a = [r.randrange(6) for _ in range(r.randrange(1, 9))]
        b = [r.randrange(6) for _ in range(r.randrange(0, 20))]
        edits, x, y = D.best_stretch(np.array(a, np.uint64), np.array(b, np.uint64))
        assert edits == least_edits(a, b) == distance(a, b[x:y])


def edit(r, w, k, vocabulary):
    w = list(w)
    for _ in range(k):
        p = r.randrange(len(w))
        kind = r.randrange(3)
        if kind == 0:
            w[p] = r.choice(vocabulary)
        elif kind == 1:
            w.insert(p, r.choice(vocabulary))
        elif len(w) > 1:
            del w[p]
    return w


def fixture(seed):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)] + ["É", "日本"]
    line = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(line(r.choice([2, 3, 5, 12, 20, 35, 60])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "one"), (103, "a b a b a b a b a b a b"), (104, items[3][1]), (None, "null id item of seven words here")]
    docs = []
    for i in range(150):
        item = r.choice(items[:25])[1].split()
        body = line(r.choice([0, 5, 80]))
        if i % 3:
            body += edit(r, item, r.randrange(0, len(item) // 4 + 1), vocabulary) + line(r.choice([0, 40]))
        docs.append((i, r.choice([" ", ", ", "\n"]).join(x.title() if i % 2 else x for x in body)))
    docs += [(900, None), (901, ""), (902, items[5][1]), (902, items[5][1]), (None, "x null id item of seven words here y"), (903, "a b " * 4000), (904, (items[6][1] + " filler ") * 40)]
    return items, docs


@pytest.mark.parametrize("part_bytes", [8 << 20, 700])
def test_brute_force(spark, part_bytes):
    items, docs = fixture(3)
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "'k' AS edits"), spark.createDataFrame(items, "item_id long, text string"), part_bytes=part_bytes).collect()
    found = sorted(((r.id, r.item_id) for r in got), key=repr)
    want, near = [], 0
    text_of = {i: words(t) for i, t in items}
    for d, t in docs:
        w = words(t)
        for i, x in text_of.items():
            if len(x) > 1 and (e := least_edits(x, w)) <= D.edits_allowed(len(x)):
                want.append((d, i))
                near += e > 0
    assert set(found) <= set(want)  # nothing that is not near
    exact = [(d, i) for d, i in want if least_edits(text_of[i], words(dict((k, v) for k, v in docs)[d])) == 0]
    assert set(exact) <= set(found)
    assert set(found) == set(want) and near > 20
    for r in got:
        w = words(dict((k, v) for k, v in docs)[r.id])
        assert distance(text_of[r.item_id], w[r.first_word : r.first_word + r.n_words]) == r.edits
        assert r.similarity == pytest.approx(1 - r.edits / len(text_of[r.item_id]))


def test_nothing_near_is_lost_at_any_length(spark):
    """Copies at the largest distance: long items are few and come last, and items of one word match."""
    r = random.Random(4)
    line = lambda n: [f"u{r.randrange(10**6)}" for _ in range(n)]
    items = [(i, line(5)) for i in range(450)] + [(1000 + i, line(n)) for i, n in enumerate((60, 200, 400) * 4)] + [(2000, ["Solo"]), (2001, ["solo"]), (2002, ["é"])]
    docs = []
    for i, x in items[440:462]:
        for c in range(6):
            docs.append((i * 10 + c, " ".join(line(30) + edit(r, x, D.edits_allowed(len(x)), line(50)) + line(r.choice([0, 30])))))
    docs += [(1, "not so(SOLO), solo"), (2, "soloist é"), (None, "solo"), (None, "none")]
    got = {(x.id, x.item_id): x for x in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in items], "item_id long, text string")).collect()}
    of = {i: [w.lower() for w in x] for i, x in items}
    want = {(d, d // 10) for d, t in docs[:132] if least_edits(of[d // 10], words(t)) <= D.edits_allowed(len(of[d // 10]))}
    assert len(want) == 132
    assert set(got) == want | {(1, 2000), (1, 2001), (2, 2002), (None, 2000), (None, 2001)}
    assert (got[1, 2000].first_word, got[1, 2000].n_words, got[1, 2000].edits, got[1, 2000].similarity) == (2, 1, 0, 1.0)


@pytest.mark.parametrize("n", [5, 8, 12, 20, 30, 60, 120, 200, 400])
def test_recall_of_the_repetitions_alone(n):
    """Copies with as many random edits as are allowed: the LSH alone holds 0.95 of each length class."""
    import numpy as np

    rng, r = np.random.default_rng(n), random.Random(n)
    new = lambda size: rng.integers(1, 2**60, size).astype(np.uint64)
    k, trials, found = D.edits_allowed(n), 60, 0
    for _ in range(trials):
        item = new(n)
        copy = np.array(edit(r, list(item), k, list(new(50))), np.uint64)
        text = np.concatenate([new(40), copy, new(40 + n)])
        starts = np.arange(40 - k, 40 + k + 1)
        got = D._verified(text, starts, 0, len(text), item, k)
        found += bool(got and got[3])
    assert found >= 0.95 * trials


def test_ties_of_equally_good_places(spark):
    """Of equally good places in one region the first end counts; of regions the first one."""
    item = "alpha beta gamma delta epsilon zeta"
    text = f"{item} x y z {'filler ' * 60} {item}"
    row = D.contaminated(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert (row.first_word, row.n_words, row.edits, row.by_lsh) == (0, 6, 0, True)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert D.contaminated(docs.limit(0), items).collect() == []
    assert D.contaminated(docs, items.limit(0)).collect() == []
    assert [(r.id, r.item_id, r.edits) for r in D.contaminated(docs, items).collect()] == [(1, 1, 0)]


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect():
        w = words(r.text)
        have = set(w)
        for i, x in items:
            if sum(t in have for t in x) >= len(x) - D.edits_allowed(len(x)) and least_edits(x, w) <= D.edits_allowed(len(x)):
                want.add((r.doc_id, i))
    got = [(r.doc_id, r.item_id) for r in D.op10_benchmark_decontamination(spark, d).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(want) > 10
    assert set(got) == want
