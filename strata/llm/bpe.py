"""BPE encoding and decoding by prefix-sharing trie traversal.

The text is normalised and cut into words as the tokenizer file prescribes (NFC, white space
dropped, lower case, contractions / letter runs / single digits / other runs, bytes as characters).
Distinct new words of a slice of documents are walked in sorted order, which is the depth-first
order of their trie: the walk keeps, for each prefix of the current word, the last token of the
prefix's encoding, and a word that shares a prefix with the one before starts from that depth.

The last token of a prefix is enough: if ``t`` ends the encoding of a prefix, the rest of it is the
encoding of the prefix without ``t``. Of the vocabulary's tokens that end the prefix exactly one
agrees with the last token before it, that is, merging the two tokens' symbols by rank gives the
two tokens back; these pair results are kept. A word's end is a symbol of its own (the last
character with the end mark), so words that share all but their end share all states before it.

White space, the words of plain chunks and the lists of ids are found for a whole slice at once in numpy and
Arrow; Python's own loops see distinct words only, and the few chunks that hold other characters.

Work is per document and per distinct word of a task, so nothing is shuffled. The tokenizer's file
is read on the driver, where its path is a parameter, and broadcast (a vocabulary, 1.7 MB here).

Cases: NULL and empty texts have no tokens and decode to an empty text; special tokens that a text
spells out are encoded as themselves, as the tokenizers library does by default; rows with equal ids are
documents of their own, and other columns than the id and the text are not read.
"""

from __future__ import annotations

import json
import os.path
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import batch_by_batch, named
from .text import Words, lower_table, slices, string_array, text_buffers, word_bytes

#: Distinct words that a task keeps encoded; then it starts anew, which bounds its memory.
KEPT_WORDS = 400_000
#: Pairs of tokens whose agreement a task keeps.
MOST_PAIRS = 1_000_000

#: Unicode's white space, as the tokenizer's pattern has it in \s.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The pattern for which the plain characters of ``_Plain`` are known; with another one all chunks are cut one by one.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_characters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    out |= {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in out)}
    return out


class WordBpe:
    """Encoder for one tokenizer file; holds the trie states of the last word and pair results."""

    def __init__(self, text: str):
        import regex

        spec = json.loads(text)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.token_of = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = (p if isinstance(p, list) else p.split(" ") for p in model["merges"])
        self.rank = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.split_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.bytes = str.maketrans({chr(b): c for b, c in byte_characters().items()})
        self.pattern_text = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(self.pattern_text.replace(r"^\s", "^" + _SPACE))
        self.spaces = re.compile(f"[{_SPACE}]+")
        #: How far back a token can start, by the last two characters that it ends with.
        self.back: dict[str, int] = {}
        self.end_back: dict[str, int] = {}
        for t in self.vocab:
            ends = self.end and t.endswith(self.end)
            body = t[: -len(self.end)] if ends else t
            back = self.end_back if ends else self.back
            back[body[-2:]] = max(back.get(body[-2:], 0), len(body))
        #: The merge that makes a token, and its two parts.
        self.made = {self.vocab[a + b]: (r, self.vocab[a], self.vocab[b]) for (a, b), r in reversed(self.rank.items()) if a + b in self.vocab}
        self.pair_rank = {self.vocab[a] << 20 | self.vocab[b]: r for (a, b), r in self.rank.items() if a in self.vocab and b in self.vocab}
        self.known: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.word, self.last, self.sizes = "", [], []  # the last token of the encoding of word[:d + 1], and its length

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1:] + self.end]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """Merging by rank, leftmost first."""
        while len(symbols) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:], strict=False)]
            least = min(ranks)
            if least == 1 << 60:
                break
            out, i = [], 0
            while i < len(symbols):
                if i < len(ranks) and ranks[i] == least:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def agrees(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens gives the two tokens back.

        The tokens' merges at their common border are undone, the latest first. Before each of them
        was done, the pair across the border stood ready as well; if its rank comes first (of equal
        ranks the left one does), it would have been merged instead."""
        x, y, made, rank = left, right, self.made, self.pair_rank
        before = 1 << 60
        while True:
            across = rank.get(x << 20 | y)
            if across is not None and across < before:
                return False
            a, b = made.get(x), made.get(y)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                before, x = a[0], a[2]
            else:
                before, y = b[0] + 1, b[1]

    def is_token(self, token: int) -> bool:
        """Whether a token's symbols merge into it (a vocabulary may hold others)."""
        known = self.alone.get(token)
        if known is None:
            text = self.token_of[token]
            known = self.alone[token] = self.merged(self.symbols(text)) == [text]
        return known

    def step(self, word: str, d: int, mark: str) -> tuple[int, int]:
        """The last token of word[:d] (with the end mark), given those of its shorter prefixes; and its length.

        Only one token agrees, so they are tried in the order in which they are likely: the last
        token grown by a character, then the shorter ones."""
        vocab, known, last = self.vocab, self.known, self.last
        grown = self.sizes[d - 2] + 1 if d > 1 else 1
        token = vocab.get(word[d - grown : d] + mark)
        if token is not None and self.fits(token, d - grown):
            return token, grown
        for size in range(1, min(d, (self.end_back if mark else self.back).get(word[max(0, d - 2) : d], 1)) + 1):
            token = vocab.get(word[d - size : d] + mark)
            if token is not None:
                if size == d:
                    ok = self.is_token(token)
                else:
                    ok = known.get(last[d - size - 1] << 20 | token)
                    if ok is None:
                        ok = self.fits(token, d - size)
                if ok:
                    return token, size
        raise ValueError(f"no token ends {word[:d]!r}")

    def fits(self, token: int, start: int) -> bool:
        """Whether the token may follow the last token of the prefix that ends where it starts."""
        if not start:
            return self.is_token(token)
        key = self.last[start - 1] << 20 | token
        ok = self.known.get(key)
        if ok is None:
            if len(self.known) > MOST_PAIRS:
                self.known.clear()
            ok = self.known[key] = self.is_token(token) and self.agrees(self.last[start - 1], token)
        return ok

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word in byte characters; cheapest when words come in sorted order."""
        before, n, shared = self.word, len(word), 0
        most = min(n - 1, len(self.last))
        if word[:most] == before[:most]:
            shared = most
        else:
            while word[shared] == before[shared]:
                shared += 1
        self.word = word
        del self.last[shared:], self.sizes[shared:]
        for d in range(shared + 1, n):
            token, size = self.step(word, d, "")
            self.last.append(token)
            self.sizes.append(size)
        token, size = self.step(word, n, self.end)
        out, d = [token], n - size
        while d > 0:
            out.append(self.last[d - 1])
            d -= self.sizes[d - 1]
        out.reverse()
        return out

    def words_of(self, text: str) -> list[str]:
        if text.isascii() or "Cn" not in map(unicodedata.category, text):
            return self.pattern.findall(text)
        # code points that a newer Unicode than the tokenizer's assigns are neither letters nor numbers to it
        known = "".join("\u2190" if unicodedata.category(c) == "Cn" else c for c in text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(known)]

    def pieces(self, chunk: str) -> list[str | int]:
        """Words in lower case, and the ids of special tokens, of a chunk without ASCII white space."""
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower()]
        out = []
        for space_free in self.spaces.split(chunk):
            for k, part in enumerate(self.split_added.split(space_free) if self.split_added else [space_free]):
                if k % 2:
                    out.append(self.added[part])
                elif part.isascii() and part.isprintable():
                    out += self.pattern.findall(part.lower())
                elif part:
                    if not part.isascii():
                        part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # no final form when lower-cased alone
                    out += self.words_of(part.lower())
        return out

    def in_bytes(self, word: str) -> str:
        """A word in byte characters."""
        if word.isascii() and word.isprintable():  # these bytes stand for themselves
            return word
        return word.encode().decode("latin-1").translate(self.bytes)


class _Plain:
    """Cuts chunks of plain characters into lower-case words, many at once: ASCII without apostrophes (which may start
    a contraction) and without what special tokens start with, and the Latin-1 letters from À to ÿ. These are letters, digits
    or others to the pattern alone, stay as they are under NFC, and have lower-case forms of one character."""

    LATIN, TIMES, DIVIDE = 0xC3, 0x97, 0xB7  # first byte of U+00C0-U+00FF; second bytes of the two that are no letters

    def __init__(self, bpe: WordBpe):
        known = bpe.pattern_text == _PATTERN and all(t[:1].isascii() for t in bpe.added)
        self.allowed = np.zeros(256, bool)
        if known:
            self.allowed[0x21:0x7F] = True
            self.allowed[[ord(c) for c in {"'", *(t[0] for t in bpe.added)}]] = False
        self.kind = np.zeros(256, np.uint8)  # 0: others
        self.kind[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), self.LATIN]] = 1
        self.kind[0x30:0x3A] = 2
        self.lower = lower_table()

    def which(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The chunks of plain characters."""
        ok = self.allowed[data]
        if self.allowed.any():
            second = (data >= 0x80) & (data < 0xC0) & (data != self.TIMES) & (data != self.DIVIDE)
            letter = (data[:-1] == self.LATIN) & second[1:]
            ok[:-1] |= letter
            ok[1:] |= letter
        bad = np.zeros(len(data) + 1, np.int64)
        np.cumsum(~ok, out=bad[1:])
        return bad[offsets[1:]] == bad[offsets[:-1]]

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The words of such chunks, in order, and how many each chunk has."""
        kind, tail = self.kind[data], data >= 0x80
        tail[data == self.LATIN] = False
        low = self.lower[data]
        low[tail & (data < 0x9F)] += 0x20
        first = kind == 2
        first[1:] |= kind[1:] != kind[:-1]
        first[offsets[:-1]] = True
        start = np.flatnonzero(first)
        return string_array(low, np.append(start, len(data))), np.diff(np.searchsorted(start, offsets))


def spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers begin[i], begin[i] + 1, ... of n[i] places each, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(begin - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def starts(n: np.ndarray) -> np.ndarray:
    return np.cumsum(n) - n


class _Slice:
    """Encodes slices of texts. Distinct chunks (what stands between ASCII white space) are cut into words once a slice;
    the encodings of words are kept."""

    def __init__(self, bpe: WordBpe):
        self.bpe, self.plain = bpe, _Plain(bpe)
        self.shown = pa.array([bpe.token_of.get(i, "") for i in range(max(bpe.token_of, default=-1) + 1)], pa.string())
        self.forget()

    def forget(self) -> None:
        self.code: dict[str | int, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.size = np.zeros(0, np.int64)

    def codes(self, words: list[str | int]) -> np.ndarray:
        """The places of words (and ids of special tokens) among those kept; new ones are encoded, in sorted order."""
        code, encode, in_bytes = self.code, self.bpe.encode_word, self.bpe.in_bytes
        new = {w for w in words if w not in code}
        flat, size = [], []
        for w in [*(w for w in new if isinstance(w, int)), *sorted(w for w in new if isinstance(w, str))]:
            own = [w] if isinstance(w, int) else encode(in_bytes(w))
            code[w] = len(code)
            flat += own
            size.append(len(own))
        self.flat = np.concatenate([self.flat, np.array(flat, np.int32)])
        self.size = np.concatenate([self.size, np.array(size, np.int64)])
        return np.fromiter(map(code.__getitem__, words), np.int64, len(words))

    def chunk_words(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many words each distinct chunk has, and the words' places, chunk by chunk."""
        data, offsets = text_buffers(chunks)
        plain, length = self.plain.which(data, offsets), np.diff(offsets)
        words, n_plain = self.plain.words(data[np.repeat(plain, length)], np.append(0, np.cumsum(length[plain])))
        words = words.dictionary_encode()
        others = [self.bpe.pieces(c) for c in chunks.filter(pa.array(~plain)).to_pylist()]
        n_words = np.zeros(len(chunks), np.int64)
        n_words[plain], n_words[~plain] = n_plain, [len(p) for p in others]
        distinct = words.dictionary.to_pylist()
        codes = self.codes([*distinct, *(w for p in others for w in p)])
        of = np.zeros(int(n_words.sum()), np.int64)
        from_plain = np.repeat(plain, n_words)
        of[from_plain] = codes[: len(distinct)][words.indices.to_numpy(zero_copy_only=False)]
        of[~from_plain] = codes[len(distinct) :]
        return n_words, of

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Numbers of tokens, their ids and their strings joined by spaces, of each text."""
        if len(self.code) > KEPT_WORDS:
            self.forget()
        data, offsets = text_buffers(texts)
        words = Words(data, offsets)
        ends = np.append(0, np.cumsum(words.end - words.start))
        chunks = string_array(data[word_bytes()[data]], ends).dictionary_encode()
        n_words, of = self.chunk_words(chunks.dictionary)
        # tokens of each distinct chunk, then those of each place
        per_word = self.size[of]
        sums = np.append(0, np.cumsum(per_word))
        n = np.diff(sums[np.append(0, np.cumsum(n_words))])
        tokens = self.flat[spread(starts(self.size)[of], per_word)]
        at = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        flat = tokens[spread(starts(n)[at], n[at])]
        per_text = np.append(0, np.cumsum(n[at]))[words.of_doc]
        lists = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), self.shown.take(pa.array(flat)))
        sent = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((per_text * 4).astype(np.int32)), pa.py_buffer(flat.astype("<i4"))])
        return np.diff(per_text), sent, pc.binary_join(lists, " ")


def _encode(tokenizer):
    def encode(batches):
        coder = _Slice(WordBpe(tokenizer.value))
        for batch in batches:
            _, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                part = batch.slice(a, b - a)
                counts, ids, decoded = coder.encode(part["text"])
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(counts, pa.int64()), ids, decoded], ["id", "n_tokens", "ids", "decoded"])

    return encode


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: (id, n_tokens, ids as little-endian unsigned 32-bit integers, the
    text that these ids decode to: their tokens joined by spaces, as the file names no decoder)."""
    if os.path.getsize(path) > 64 << 20:
        raise ValueError("a tokenizer file of over 64 MB is not broadcast")
    with open(path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    schema = StructType([kept.schema["id"], *StructType.fromDDL("n_tokens bigint, ids binary, decoded string")])
    return kept.mapInArrow(batch_by_batch(_encode(tokenizer)), schema)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_bpe_coding(spark, sf_dir: str) -> DataFrame:
    return digests(encode_and_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path()))
