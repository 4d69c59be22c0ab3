"""Cross-tokenizer alignment against the libraries' tokens and a plain pairing of all tokens."""

import hashlib
import json
import random
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import alignment as A
from strata.llm.bpe import byte_characters

BYTE, PIECE = A.tokenizer_paths()


@pytest.fixture(scope="module")
def libraries():
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    back = {c: b for b, c in byte_characters().items()}
    with open(BYTE, encoding="utf-8") as f:
        a_bytes = {i: bytes(back.get(c, 0) for c in t) for t, i in json.load(f)["model"]["vocab"].items()}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    b_bytes = {i: bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i in range(model.get_piece_size()) for p in [model.id_to_piece(i)]}
    return library, a_bytes, model, b_bytes


def spans(ids, table):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(table[i])))
        at += len(table[i])
    return out


def brute(rows, libraries):
    library, a_bytes, model, b_bytes = libraries
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a = library.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        want = b" " + (text or "").encode()
        if not text or b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            a, b = [], []
        sa, sb = spans(a, a_bytes), spans(b, b_bytes)
        links = [(x, y) for x, (p, q) in zip(a, sa, strict=True) for y, (r, s) in zip(b, sb, strict=True) if p < s and r < q]
        common = sorted({q for _, q in sa} & {q for _, q in sb})
        groups, before = [], 0
        for c in common:
            groups.append(",".join(str(x) for x, (_, q) in zip(a, sa, strict=True) if before < q <= c) + "|" + ",".join(str(x) for x, (_, q) in zip(b, sb, strict=True) if before < q <= c))
            before = c
        docs.append((doc_id, a, b, groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    for doc_id, a, b, groups, links in docs:
        listing = ";".join(groups)
        yield (
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links),
            hashlib.sha256(listing.encode()).hexdigest() if a else "",
        )


def some_rows():
    r = random.Random(9)
    letters = "abcdefghinorstABC äöüéèñ  \n\t.,'!?()01239日本語🙂ا-_<>|"
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randrange(60)))) for i in range(150)]
    rows += [(200, "a▁b"), (201, "<|endoftext|> <s> <0x41> x"), (202, " "), (203, "  two  spaces  "), (204, "\x00é́\r\n"), (205, "un" * 400)]
    rows += [(300 + i, "The same words, in the same order.") for i in range(60)]
    return [*rows, (None, None), (None, "twice"), (7, "twice"), (7, "twice"), (8, "")]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_against_brute_force(spark, libraries, tmp_path):
    rows = some_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS id", "1 AS pairs", "2 AS home").repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = A.op11_cross_tokenizer_alignment(spark, str(tmp_path))
    assert out.columns == COLUMNS
    assert ordered(out.collect()) == ordered(brute(rows, libraries))


def test_many_homes_give_the_same(spark, libraries):
    rows = some_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = A.score_links(A.digests(A.align(docs, BYTE, PIECE)), home_links=100).withColumnRenamed("id", "doc_id").select(COLUMNS)
    assert ordered(out.collect()) == ordered(brute(rows, libraries))


def test_given_table(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in A.op11_cross_tokenizer_alignment(spark, sf).collect()}
    assert len(got) == len(rows)
    library, _, model, _ = libraries
    for doc_id, text in rows:
        n_a, n_b = len(library.encode(" " + (text or ""), add_special_tokens=False).ids), len(model.encode(text or ""))
        assert (got[doc_id].n_a, got[doc_id].n_b) in ((n_a, n_b), (0, 0))
        assert got[doc_id].n_links <= n_a + n_b and got[doc_id].n_best <= got[doc_id].n_links <= got[doc_id].count_sum or not n_a


def test_listing_is_kept(spark, libraries):
    library, _, model, _ = libraries
    docs = spark.createDataFrame([("k", "Hello worldly")], "name string, body string")
    row = A.score_links(A.align(docs, BYTE, PIECE, "name", "body")).first()
    ids = row["groups"].replace(";", ",").replace("|", ",").split(",")
    assert row["id"] == "k" and sorted(map(int, ids)) == sorted([*library.encode(" Hello worldly").ids, *model.encode("Hello worldly")])


def test_encoder_equals_the_tokenizers_library(libraries):
    library = libraries[0]
    with open(BYTE, encoding="utf-8") as f:
        own = A.ByteLevel(f.read())
    texts = [f"a{chr(c)}1 {chr(c)}{chr(c)}b\t{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x30000 or c % 64 == 0)]
    texts += ["<|endoftext|> x", "  \n\n x  ", "it's WE'LL 's", "a" * 2000, " " * 1000 + "x", "ab" * 3000]
    for k in range(0, len(texts), 20000):
        want = [x.ids for x in library.encode_batch_fast([" " + t for t in texts[k : k + 20000]], add_special_tokens=False)]
        assert own.encode(texts[k : k + 20000]) == want


def test_other_order_of_merges_is_refused():
    spec = {"added_tokens": [], "model": {"vocab": {"a": 0, "b": 1, "ab": 3, "aa": 2}, "merges": ["a b", "a a"]}}
    with pytest.raises(ValueError, match="order"):
        A.ByteLevel(json.dumps(spec))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = A.score_links(A.digests(A.align(docs, BYTE, PIECE)))
    assert out.collect() == [] and "count_sum" in out.columns


def test_overlaps_of_sides_without_tokens():
    none = A.Side([[], []], np.zeros(1, np.int64), np.zeros(3, np.int64))
    assert [len(x) for x in A.overlaps(none, none)] == [0, 0]


def test_a_task_holds_one_slice():
    """What a task takes beside its batch and its tokenizers does not follow from the batch: each slice is gone before the next."""
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 9))) for _ in range(3000)]
    texts = [" ".join(r.choice(words) for _ in range(500)) for _ in range(700)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(len(texts))), "text": pa.array(texts)})
    assert batch.nbytes > 1_500_000
    with open(BYTE, encoding="utf-8") as f, open(PIECE, "rb") as g:
        rows = A._align(SimpleNamespace(value=(f.read(), g.read())))(iter([batch.slice(0, 1), batch]))
    assert len(next(rows)) == 1
    tracemalloc.start()
    try:
        assert sum(map(len, rows)) == len(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50_000_000
