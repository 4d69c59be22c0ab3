"""The pipeline: stages against brute-force versions of what they keep, on planted and given documents."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from strata.llm.bpe import tokenizer_path
from strata.llm.decontaminate import edits_allowed

from .test_decontaminate import least_edits, words
from .test_jaccard import brute as brute_groups
from .test_windows import brute as brute_windows


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A small corpus with toxic documents, copies, near copies, shared passages and benchmark items."""
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(900)] + ["né", "Öl"]
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    bad = ["vile", "rotten", "scoundrel"]
    rows, labels, passage = [], [], line(60)
    items = [(i, line(30)) for i in range(12)]
    for i in range(260):
        t = line(r.randrange(30, 140))
        toxic = int(i % 5 == 1)
        if toxic:
            w = t.split()
            for b in bad:
                w.insert(r.randrange(len(w)), b)
            t = " ".join(w)
        elif i % 13 == 2:
            t = rows[r.randrange(len(rows))][1] if r.random() < 0.5 else rows[r.randrange(len(rows))][1] + " tail"
        elif i % 13 == 4:
            t += "\n" + passage + "\n" + line(5)
        elif i % 13 == 6:
            t += " " + items[i % 12][1] + " " + line(9)
        rows.append((i, t, "en", f"src{i % 3}", len(t)))
        if i < 200:
            labels.append((i, 1, int(any(b in t.split() for b in bad))))
    rows += [(500, None, None, None, None), (501, "", "en", "x", 0), (502, rows[7][1], "en", "y", 3), (503, line(40), "en", "z", 1), (503, None, "en", "z", 1)]
    rows.append(rows[-3])
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, labels, items, bad


def test_stages_against_brute_force(spark, corpus):
    d, rows, labels, items, bad = corpus
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{d}/documents.parquet")

    clean = P.drop_toxic(spark, docs, d)
    assert clean.columns == names
    now = sorted((tuple(x) for x in clean.collect()), key=repr)
    toxic = [x for x in rows if any(b in (x[1] or "").split() for b in bad)]
    assert {x for x in rows if x not in toxic} <= set(now) <= set(rows)  # clean documents stay as they are
    assert len(set(now) & set(toxic)) <= 0.1 * len(toxic)

    one = P.drop_near_duplicates(spark, spark.createDataFrame(now, docs.schema), d)
    assert one.columns == names
    groups = brute_groups([x[:2] for x in now])
    heads = {k for k, _, c in groups if k == c}
    want = sorted({x for x in now if x[0] in heads}, key=repr)
    now = sorted((tuple(x) for x in one.collect()), key=repr)
    assert now == want and len(now) < len(groups)

    cut = P.drop_repeated_passages(spark, spark.createDataFrame(now, docs.schema), d)
    assert cut.columns == names
    want = sorted(((i, t, *x[2:4], len(t)) for x, (i, _, _, t) in zip(now, brute_windows([x[:2] for x in now], 20))), key=repr)
    now = sorted((tuple(x) for x in cut.collect()), key=repr)
    assert now == want

    left = P.drop_contaminated(spark, spark.createDataFrame(now, docs.schema), d)
    assert left.columns == names
    held = {x[0] for x in now for _, t in items if least_edits(words(t), words(x[1])) <= edits_allowed(len(words(t)))}
    want = sorted((x for x in now if x[0] not in held), key=repr)
    now = sorted((tuple(x) for x in left.collect()), key=repr)
    assert now == want and held

    library = Tokenizer.from_file(tokenizer_path())
    got = {(x.doc_id, x.n_tokens, bytes(x.ids)) for x in P.encode(spark, spark.createDataFrame(now, docs.schema), d).collect()}
    assert got == {(x[0], len(ids), np.array(ids, "<u4").tobytes()) for x in now for ids in [library.encode(x[1], add_special_tokens=False).ids]}
    assert {(x.doc_id, x.n_tokens, bytes(x.ids)) for x in P.run(spark, d).collect()} == got


def test_verdicts_are_by_row(spark, corpus):
    """NULL and shared ids: what is contaminated or a copy goes, clean rows under the same id stay."""
    d, _, _, items, _ = corpus
    r = random.Random(5)
    line = lambda n: " ".join(f"z{r.randrange(10**6)}" for _ in range(n))
    a, b, c, e = (line(60) for _ in range(4))
    leak = lambda: line(20) + " " + items[3][1] + " " + line(5)
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    of = lambda rows: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)

    rows = [(None, leak()), (None, a), (None, None), (7, leak()), (7, b), (7, ""), (8, leak()), (9, c)]
    left = sorted(((x.doc_id, x.text) for x in P.drop_contaminated(spark, of(rows), d).collect()), key=repr)
    assert left == sorted([(None, a), (None, None), (7, b), (7, ""), (9, c)], key=repr)

    # copies of a under NULL, 7 (twice) and 5; b only with copies under NULL; wordless rows are no copies
    rows = [(None, a), (7, a), (7, a), (5, a + " tail"), (None, b), (None, b + " tail"), (None, c), (7, e), (None, None), (None, None), (7, ""), (7, "")]
    left = [(x.doc_id, x.text) for x in P.drop_near_duplicates(spark, of(rows), d).collect()]
    assert len([x for x in left if x[1] in (b, b + " tail")]) == 1
    rest = sorted((x for x in left if x[1] not in (b, b + " tail")), key=repr)
    assert rest == sorted([(5, a + " tail"), (None, c), (7, e), (None, None), (None, None), (7, ""), (7, "")], key=repr)

    rows = [(7, a), (7, a), (7, e)]  # one row of the group's own id stays, other texts of that id too
    left = sorted((x.doc_id, x.text) for x in P.drop_near_duplicates(spark, of(rows), d).collect())
    assert left == sorted([(7, a), (7, e)])


def test_clashing_columns_and_a_long_text(spark, corpus, tmp_path):
    """Stages see the same rows whatever the other columns are called; a text of a million characters passes."""
    import os

    d, rows, labels, items, bad = corpus
    docs = spark.read.parquet(f"{d}/documents.parquet")
    long = spark.createDataFrame([(900, " ".join(f"u{i}" for i in range(150_000)), "en", "s", 1)], docs.schema)
    more = docs.union(long).selectExpr("*", "1 AS id", "2.5 AS score", "'r' AS row", "3 AS gone_id", "4 AS gone0", "'e' AS extra", "5 AS GONE1", "6 AS component", "7 AS text_hash")
    more.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        os.symlink(f"{d}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    got = sorted(map(tuple, P.run(spark, str(tmp_path)).select("doc_id", "ids_sha256").collect()), key=str)
    want = sorted(map(tuple, P.run(spark, d).select("doc_id", "ids_sha256").collect()), key=str)
    assert [r for r in got if r[0] != 900] == want and len(got) == len(want) + 1
    kept = more
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, d)
        assert kept.columns == more.columns, name


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard", "substring_dedup", "decontamination", "bpe"]
    assert P.ORACLE_SQL is None


def test_empty_documents(spark, corpus):
    d = corpus[0]
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, d).collect() == []


def test_planted_cases_on_the_given_tables(spark):
    d = "/root/testdata/sf0.01"
    out = {x.doc_id for x in P.run(spark, d).select("doc_id").collect()}
    toxic = {x.doc_id for x in spark.read.parquet(f"{d}/labels.parquet").where("toxic = 1").collect()}
    held = {i for i in toxic if zlib.crc32(str(i).encode()) % 5}
    assert len(held & out) <= 0.1 * len(held)
    assert 400 < len(out) < 1000


def test_near_duplicates_reads_no_sets_of_large_texts_that_only_share_a_passage(spark, monkeypatch):
    """Texts whose lists turn out long, but which are far from linking, all stay, and none of them is written or probed as a set; a copy goes."""
    from strata.llm import jaccard

    r = random.Random(4)
    passage = [f"p{i}" for i in range(1500)]
    texts = [" ".join(passage + [f"w{r.randrange(10**6)}" for _ in range(900)]) for _ in range(20)]
    near = " ".join(f"n{i}" for i in range(200))
    rows = list(enumerate([*texts, near, near + " end"]))
    tried, linked = [], jaccard._linked
    monkeypatch.setattr(jaccard, "SHORT", 3)
    monkeypatch.setattr(jaccard, "HEAVY_IN_SLICE", 1000)
    monkeypatch.setattr(jaccard, "_linked", lambda tries, sets: tried.append((tries.count(), sets.count())) or linked(tries, sets))
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    assert sorted(x["doc_id"] for x in P.drop_near_duplicates(spark, docs, "").collect()) == list(range(21))
    assert tried == [(1, 2)]
