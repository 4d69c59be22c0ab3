"""SentencePiece coding against the sentencepiece library: ids, source spans, decoded text, normalisation."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from strata.llm import pieces as P


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.model_path())


@pytest.fixture(scope="module")
def model():
    with open(P.model_path(), "rb") as f:
        return P.PieceModel(f.read())


def texts():
    r = random.Random(3)
    out = ["", " ", "  a  b", "\n\n x\n", "▁", "a▁b ▁ c▁", "<s></s><unk><0x41>", "\x00\x01é́日本🙂 🙂🙂", "a" * 3000, "abcd " * 2000, " " * 500 + "x", " " * 129, "snake_case __x ²²². m². f(x)_{i}", "1 234,567.89 don't can't", "  　​z", "é" * 70]
    letters = "abcdefghijklmnopqrstuvwxyzABCäöüßéèñ ▁  _{}()²³-\"'.,;!?0123456789\n\t日本語🙂ا"
    out += ["".join(r.choice(letters) for _ in range(r.randrange(80))) for _ in range(600)]
    out += ["".join(r.choice("aeinorst ") for _ in range(r.randrange(200))) for _ in range(300)]
    blocks = [(1, 0x250), (0x370, 0x700), (0x900, 0xE00), (0x1E00, 0x2100), (0x4E00, 0x9FFF), (0x10000, 0x1FFFF)]
    out += ["".join(chr(r.randrange(*r.choice(blocks))) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    return out


def test_library(spark, library):
    given = texts()
    docs = spark.createDataFrame([*enumerate(given), (-1, None)], "doc_id long, text string").repartition(2)
    got = {x.id: x for x in P.encode_pieces(docs, P.model_path()).collect()}
    assert got[-1].n_tokens == 0 and got[-1].ids == [] and got[-1].decoded == ""
    for i, t in enumerate(given):
        want = library.encode(t)
        spans = [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]
        assert got[i].ids == want and got[i].n_tokens == len(want), repr(t)
        assert list(zip(got[i].begins, got[i].ends, strict=True)) == spans, repr(t)
        assert got[i].decoded == library.decode(want), repr(t)


def test_decoding_of_any_ids(library, model):
    r = random.Random(4)
    for _ in range(1500):
        ids = [r.choice([r.randrange(0, 259), r.randrange(0, 32000)]) for _ in range(r.randrange(12))]
        assert model.decode(ids) == library.decode(ids), ids


def test_side_by_side_equals_one_by_one(model):
    r = random.Random(5)
    words = {"".join(r.choice("▁abeinorst,.é") for _ in range(r.randrange(1, 24))) for _ in range(3000)}
    coder = P._Coder(model)
    coder.learn(words)
    ends = np.cumsum(coder.size)
    for w in words:
        k = coder.code[w]
        own = coder.flat[:, ends[k] - coder.size[k] : ends[k]].tolist()
        assert own == [list(x) for x in model.encode_chunk(w)], w
        assert model.merge(list(w)) == model._merge_by_heap(list(w)), w


@pytest.mark.parametrize("rules", [{"rule_name": "nmt_nfkc"}, {"rule_name": "nfkc_cf"}, {"rule_name": "nfkc", "remove_extra_whitespaces": False}, {"rule_name": "nmt_nfkc", "add_dummy_prefix": False, "remove_extra_whitespaces": False}])
def test_compiled_character_map(rules):
    """Longest-prefix normalisation and its alignment against the library's, for maps that the library brings."""
    library = sentencepiece.SentencePieceNormalizer(**rules)
    spec = dict(P.fields(library.serialized_normalizer_spec()))
    own = P.Normalizer(spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)))
    for t in [*texts(), "①ｱ  x ", "  ﬁ ﷺ ", "　 a　　b ", "ẹ́ 각 가", "   "]:
        want, places = library.normalize(t, with_offsets=True)
        norm, align = own(t.encode())
        assert norm.decode() == want, repr(t)
        at = np.cumsum([0, *(len(c.encode()) for c in want)])
        char = {len(t[:i].encode()): i for i in range(len(t) + 1)}
        assert [char[int(align[k])] for k in at] == places, repr(t)


def test_refused_models():
    def message(number, blob):
        return bytes([number << 3 | 2, len(blob)]) + blob

    with pytest.raises(ValueError, match="BPE"):
        P.PieceModel(message(2, b"\x18\x01"))
    with pytest.raises(ValueError, match="user-defined"):
        P.PieceModel(message(1, message(1, b"x") + b"\x18\x04") + message(2, b"\x18\x02"))


def test_query_and_clashing_columns(spark, library, tmp_path):
    rows = [(1, "Ein Satz, zwei  Sätze."), (1, "again"), (None, None), (None, "x"), (2, "")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' AS ids", "'b' AS id", "1 AS begins").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def want(i, t):
        ids = library.encode(t or "")
        return i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))

    key = lambda r: tuple((x is None, x) for x in r)
    out = P.op12_sentencepiece_coding(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect()), key=key) == sorted((want(*r) for r in rows), key=key)


def test_given_table(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in P.op12_sentencepiece_coding(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "")
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").replace("▁", " ").encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.digests(P.encode_pieces(docs, P.model_path())).collect() == []
