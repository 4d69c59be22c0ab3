"""BPE against the tokenizers library: ids and decoded text must be equal."""

import hashlib
import json
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm.bpe import WordBpe, _encode, encode_and_decode, op9_bpe_coding, tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def texts():
    r = random.Random(5)
    out = [None, "", "   ", "\x00\x1c\x1f x", "Hello, WORLD!! it's we'll '' 's'sfoo 123 x²½", "<|endoftext|>a<|startoftext|> b<|ENDOFTEXT|>", "ΟΔΟΣ Σ ΣΑΣ İstanbul ǅ ẞ", "e\u0301 \u0301 a\u0300\u0316b Å ﬁ 각 ᄀ\u1161", "日本語 テキスト\u3000全角 🙂🙂 \u200b\u2028z", "a" * 3000, "!" * 50 + "?" * 7]
    letters = "abcdefghijklmnopqrstuvwxyzABCäöüßéèñçø '\"-.,!?0123456789\n\t日本🙂ا"
    for _ in range(400):
        out.append("".join(r.choice(letters) for _ in range(r.randrange(60))))
    for _ in range(400):
        out.append("".join(r.choice("aeinorst") for _ in range(r.randrange(1, 40))))
    for _ in range(300):
        out.append("".join(chr(r.choice([r.randrange(1, 0x250), r.randrange(0x370, 0x700), r.randrange(0x1E00, 0x2100)])) for _ in range(r.randrange(1, 25))))
    return out


def test_library(spark, library):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(2)
    got = {x.id: (x.n_tokens, bytes(x.ids), x.decoded) for x in encode_and_decode(docs, tokenizer_path()).collect()}
    for i, t in enumerate(texts()):
        assert got[i] == want(library, t), repr(t)


def test_every_token_is_reached_by_pairs(library):
    """Trie states against merging each word alone, over all words that the vocabulary spells."""
    with open(tokenizer_path(), encoding="utf-8") as f:
        bpe = WordBpe(f.read())
    words = sorted({t.removesuffix("</w>") for t in bpe.vocab if t.isalpha()})[::7]
    for w in words:
        assert [bpe.token_of[t] for t in bpe.encode_word(w)] == bpe.merged([*w[:-1], w[-1] + "</w>"]), w


def test_pairs_agree_as_merging_says():
    with open(tokenizer_path(), encoding="utf-8") as f:
        bpe = WordBpe(f.read())
    r = random.Random(4)
    left = [i for t, i in bpe.vocab.items() if not t.endswith("</w>") and t.isalpha()]
    right = [i for t, i in bpe.vocab.items() if t.removesuffix("</w>").isalpha()]
    for _ in range(20000):
        a, b = r.choice(left), r.choice(right)
        x, y = bpe.token_of[a], bpe.token_of[b]
        if bpe.is_token(a) and bpe.is_token(b):
            assert bpe.agrees(a, b) == (bpe.merged([*bpe.symbols(x), *bpe.symbols(y)]) == [x, y]), (x, y)


def test_query_on_the_whole_table(spark, library):
    d = "/root/testdata/sf0.01"
    got = {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in op9_bpe_coding(spark, d).collect()}
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, t in rows:
        n, ids, decoded = want(library, t)
        assert got[i] == (n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_empty_table(spark):
    assert encode_and_decode(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).collect() == []


def test_repeated_ids_clashing_columns_and_a_long_text(spark, library):
    long = "Lorem IPSUM dolor, " * 40_000
    docs = spark.createDataFrame([(1, "one"), (1, "two words"), (None, None), (2, long)], "doc_id long, text string").selectExpr("*", "'x' AS id", "3 AS ids", "4 AS n_tokens", "'d' AS decoded")
    got = sorted(((x.id, x.n_tokens, bytes(x.ids), x.decoded) for x in encode_and_decode(docs, tokenizer_path()).collect()), key=str)
    assert got == sorted(((i, *want(library, t)) for i, t in [(1, "one"), (1, "two words"), (None, None), (2, long)]), key=str)


def coded(file_text, *slices_of_texts):
    batches = [pa.RecordBatch.from_arrays([pa.array(range(len(t))), pa.array(t, pa.string())], ["id", "text"]) for t in slices_of_texts]
    return [(x["n_tokens"], x["ids"], x["decoded"]) for b in _encode(SimpleNamespace(value=file_text))(iter(batches)) for x in b.to_pylist()]


def test_a_word_is_encoded_once_in_a_task(monkeypatch, library):
    """Whatever stands around it, and in whichever batch."""
    seen, encode, pieces, cut = [], WordBpe.encode_word, WordBpe.pieces, []
    monkeypatch.setattr(WordBpe, "encode_word", lambda self, w: seen.append(w) or encode(self, w))
    monkeypatch.setattr(WordBpe, "pieces", lambda self, c: cut.append(c) or pieces(self, c))
    first, then = ["Größe word, 1word", "word; <|endoftext|>größe's"], ["(word) WORD? größe!", "größe... word's ÷ ×2"]
    with open(tokenizer_path(), encoding="utf-8") as f:
        assert coded(f.read(), first, then) == [want(library, t) for t in first + then]
    assert len(seen) == len(set(seen))
    assert set(cut) == {"<|endoftext|>größe's", "word's", "÷", "×2"}  # all others are cut together


def test_plain_characters_are_known_for_one_pattern_only():
    with open(tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    split["pattern"]["Regex"] = split["pattern"]["Regex"].replace(r"[\p{N}]|", r"[\p{N}]+|")
    other = json.dumps(spec)
    some = ["123 4a56, 7!8", *(t for t in texts()[11:400] if t)]
    assert coded(other, some) == [want(Tokenizer.from_str(other), t) for t in some]


def test_a_large_batch_is_encoded_in_slices():
    """A worker holds the tokens of about a megabyte of text at once, whatever comes in one batch."""
    with open(tokenizer_path(), encoding="utf-8") as f:
        run = _encode(SimpleNamespace(value=f.read()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["Some words. " * 50_000] * 6)], ["id", "text"])
    out = list(run(iter([batch])))
    assert [b.num_rows for b in out] == [1] * 6 and [x for b in out for x in b["n_tokens"].to_pylist()] == [150_000] * 6
