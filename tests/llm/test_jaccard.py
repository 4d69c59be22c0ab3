"""Jaccard join over word shingles against all pairs by brute force."""

import random
import re

import pytest

from strata.llm import jaccard
from strata.llm import jaccard as J
from strata.llm.components import components
from strata.llm.jaccard import near_duplicates, op8_ngram_jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holds = {}
    for i, s in enumerate(sets):
        for x in s:
            holds.setdefault(x, []).append(i)
    tried = set()
    for group in holds.values():
        for k, i in enumerate(group):
            for j in group[k + 1 :]:
                if (i, j) not in tried:
                    tried.add((i, j))
                    if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                        root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 62), 1 << 62 if k is None else k)
    return sorted([(k, len(s), None if (m := least[find(i)] if s else (1 << 62 if k is None else k)) == 1 << 62 else m) for i, ((k, _), s) in enumerate(zip(rows, sets))], key=repr)


def fixture(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    line = lambda n: [r.choice(words) for _ in range(n)]
    base, passage, rows = line(120), line(60), []
    for i in range(80):  # near copies: some link, some only by way of others
        w = list(base)
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append(w)
    for i in range(60):  # a passage that many share, and that fills up to all of a text
        rows.append(line(r.randrange(0, 60)) + passage)
    chain = line(200)
    for i in range(40):
        chain = chain[3:] + line(3)
        rows.append(list(chain))
    rows += [line(n) for n in [0, 1, 1, 2, 4, 5, 6, 9, 30]]
    rows += [["x"], ["x"], ["X"], ["x", "y"], ["x", "y"], rows[3], rows[3], line(30000)]
    texts = [r.choice([" ", "\n", "\t "]).join(w) for w in rows] + [None, "", " \n", None]
    ids = r.sample(range(-50, 10000), len(texts))
    out = list(zip(ids, texts)) + [(None, texts[5]), (None, "only here"), (None, None)]
    out.append(out[7])
    r.shuffle(out)
    return out


@pytest.mark.parametrize("slice_bytes, short", [(2000, 3), (8 << 20, 32)])
def test_brute_force(spark, monkeypatch, slice_bytes, short):
    monkeypatch.setattr(jaccard, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", 16 if short < 32 else 4096)
    rows = fixture(slice_bytes)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS key", "1 AS list").repartition(3)
    assert sorted((tuple(x) for x in near_duplicates(docs).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("words", [516, 1028])
def test_brute_force_where_sketches_differ_in_width(spark, monkeypatch, words):
    """Near copies on both sides of a power of two of shingles, found by long lists only, by short ones, and by both."""
    r = random.Random(words)
    vocabulary = [f"w{i}" for i in range(400)]
    base, rows = [r.choice(vocabulary) for _ in range(words + words // 8)], []
    for _ in range(40):
        w = base[: len(base) - r.randrange(words // 4)]
        for _ in range(r.randrange(words // 50)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append(w)
    rows += [base[: r.randrange(20, words)] + [r.choice(vocabulary) for _ in range(r.randrange(words // 3))] for _ in range(20)]
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert 1 < len({c for _, _, c in want}) < 50 and len({n > words - 4 for _, n, _ in want}) == 2
    for short, block, in_slice in ((3, 16, 2), (3, 4096, 1000), (32, 16, 1000)):
        monkeypatch.setattr(jaccard, "SHORT", short)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "HEAVY_IN_SLICE", in_slice)
        assert sorted((tuple(x) for x in near_duplicates(docs).collect()), key=repr) == want


@pytest.mark.parametrize("shared", [1500, 100, 8])
def test_large_texts_with_common_passages_are_not_read_again(spark, monkeypatch, shared):
    """Texts of 2400 words that share a passage, of which lists turn out long, but are far from linking: no pair is probed and
    no set is written."""
    r = random.Random(shared)
    passage = [f"p{i}" for i in range(shared)]
    rows = [(i, " ".join(passage + [f"w{r.randrange(10**6)}" for _ in range(2400 - shared)])) for i in range(24)]
    seen, linked = [], jaccard._linked
    monkeypatch.setattr(jaccard, "SHORT", 3)
    monkeypatch.setattr(jaccard, "HEAVY_IN_SLICE", 1000)  # known beforehand of none
    monkeypatch.setattr(jaccard, "_linked", lambda tries, sets: seen.append((tries.count(), sets.count())) or linked(tries, sets))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(x) for x in got) == [(i, len(shingles(t)), i) for i, t in rows]
    assert set(seen) <= {(0, 0)}


def test_sketch_bound_holds_for_all_links():
    import numpy as np
    import pyarrow as pa

    r, g, pairs = random.Random(5), np.random.default_rng(5), []
    while len(pairs) < 300:
        s = np.unique(g.integers(0, 1 << 63, r.choice([1, 9, 400, 520, 600, 1030, 2500]), np.uint64))
        x = s[: len(s) - r.randrange(len(s) // 5 + 1)]
        y = np.union1d(s[r.randrange(len(s) // 8 + 1) :], g.integers(0, 1 << 63, r.randrange(len(s) // 9 + 1), np.uint64))
        pairs.append((x, y))
    common = [len(np.intersect1d(x, y)) for x, y in pairs]
    link = [100 * n >= 80 * (len(x) + len(y) - n) for (x, y), n in zip(pairs, common)]
    far = [(x, np.sort(g.integers(0, 1 << 63, len(x), np.uint64))) for x, _ in pairs]
    assert 50 < sum(link) < 300
    both = pairs + far
    rows = {"a": range(len(both)), "b": range(len(both)), "size_a": [len(x) for x, _ in both], "size_b": [len(y) for _, y in both], "sketch_a": [J._sketch(x) for x, _ in both], "sketch_b": [J._sketch(y) for _, y in both]}
    kept = {x for b in J._within([pa.RecordBatch.from_pydict({k: pa.array(list(v)) for k, v in rows.items()})]) for x in b["a"].to_pylist()}
    assert {i for i, y in enumerate(link) if y} <= kept and not [i for i in kept if i >= len(pairs)]


def test_rarest_shingles_hold_enough_of_any_partner():
    """The lists of two sets that link have c sets in common at least, whatever shingles are frequent."""
    import numpy as np

    r = random.Random(3)
    for _ in range(300):
        n = r.randrange(1, 150)
        x = r.sample(range(400), n)
        y = list(set(x[: n - r.randrange(n // 5 + 1)] + r.sample(range(400), r.randrange(n // 5 + 1))))
        a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
        if 100 * len({*x} & {*y}) < 80 * len({*x} | {*y}):
            continue
        k = r.choice([40, 150, 300, 390])
        heavy = np.array(sorted(r.sample(range(400), k)), np.uint64)
        rank = np.array(r.sample(range(k), k), np.int64)
        long = rank >= r.choice([k, k // 2, k // 10, 0])
        (own_a, need_a), (own_b, need_b) = (jaccard._rarest(s, heavy, rank, long) for s in (a, b))
        need = min(need_a, need_b) % jaccard.ONLY_LONG
        assert need >= 1 and len(set(own_a.tolist()) & set(own_b.tolist())) >= need


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 160)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(70)]
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(tuple(x) for x in components(spark.createDataFrame(links, "a long, b long")).collect())
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_the_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(x) for x in op8_ngram_jaccard_join(spark, d).collect()), key=repr)
    assert got == brute(rows)
    assert any(k != c for k, _, c in got)


def _entries(texts):
    """What sets send, in one bucket, with the frequent shingles of all of them."""
    import numpy as np
    import pyarrow as pa

    class Value:
        def __init__(self, value):
            self.value = value

    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "text": pa.array(texts)})
    rows = pa.Table.from_batches(list(J._survey(5)([batch])))
    counted = rows.filter(pa.compute.is_valid(rows["shingle"])).group_by("shingle").aggregate([("count", "sum")]).sort_by([("count_sum", "descending")])
    heavy, count = counted["shingle"].to_numpy().view(np.uint64), counted["count_sum"].to_numpy()
    order = np.argsort(heavy)
    rank = np.arange(len(heavy))[::-1][order]
    frequent = Value((heavy[order].tobytes(), rank.astype(np.int64).tobytes(), (count[order] > J.SHORT).tobytes()))
    return J._merge_lists(pa.Table.from_batches(list(J._short_lists(5, 1, frequent)([batch]))))


@pytest.mark.parametrize("share", [0.5, 0.70, 0.78])
def test_template_pages_are_not_compared_with_each_other(share):
    """Pages of which a site's template is most, but not enough to link: what is tried grows with the pages, not their square."""
    import numpy as np

    def tried(pages):
        r = random.Random(3)
        template = " ".join(f"t{i}" for i in range(int(200 * share)))
        own = lambda: " ".join(f"w{r.randrange(10**6)}" for _ in range(200 - int(200 * share)))
        out = _entries([f"{template} {own()}" for _ in range(pages)])
        return len(np.frombuffer(out["a"][0].as_py(), np.int64)) + len(np.frombuffer(out["key"][0].as_py(), np.int64))

    assert tried(500) <= 20 and tried(1000) <= 40


def test_sets_with_few_rare_shingles_find_their_partners():
    """The T - L rule loses no pair: sets that differ in how much of them is in long lists."""
    import numpy as np

    rare, heavy = np.arange(10, dtype=np.uint64), np.arange(1000, 1090, dtype=np.uint64)
    rank, long = np.arange(90), np.ones(90, bool)
    for n_rare in range(1, 11):
        for n_long in (0, 5, 20, 39, 40, 41, 90):
            s = np.concatenate([rare[:n_rare], heavy[:n_long]])
            own, c = J._rarest(s, heavy, rank, long)
            need = -(-4 * len(s) // 5)
            if n_long >= need:
                assert c > J.ONLY_LONG and set(rare[:n_rare]) <= set(own)
            else:
                assert 1 <= c < J.ONLY_LONG and not set(own) & set(heavy)
                assert len(own) - c <= n_rare - (need - n_long)  # a partner can miss no more than that
