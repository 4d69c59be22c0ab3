"""Language ID: word-first backoff over word and character n-gram frequencies.

The model holds, for each learned language, log relative frequencies of words and of character
n-grams (1 to ``LONGEST`` characters, with the word's borders). A known word scores by its words'
frequencies; an unseen word falls back to its longest n-grams, and where none of them is known to
progressively shorter ones. A document's language has the highest sum over its words; ``score`` is the
probability that the mean over its words gives it, sharpened by the number of words up to ``SURE``.

Words are runs of letters, lower-cased character by character. The model is fitted on the whole texts
of at most ``SAMPLE`` labelled documents of each language (those whose ids and texts hash lowest); Spark
counts their words and n-grams, pre-aggregated in each task, and the ``MOST`` most frequent of each kind in
each language are broadcast, so that no language takes another one's places.
Scoring is one pass without a shuffle, in which a slice's distinct words are scored once.

Cases: NULL texts and texts without a letter are ``und`` with score 0, as is everything if there is no
labelled row; rows without a language teach nothing; rows that repeat an id and a text count once for the
bound of the sample; equal sums go to the language that sorts first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage

from . import labels as L
from .exchange import named
from .text import Roller, Words, mix, slices, text_buffers

#: Labelled documents of each language that the model is fitted on at most.
SAMPLE = 6_000
#: Words, and n-grams of each length, of each language that the model keeps at most (12 bytes and 4 for each language).
MOST = 40_000
#: Parts in which a language's most frequent entries are found before they are compared.
_PARTS = 64
LONGEST = 4
#: Words that make a document's score as sure as it gets.
SURE = 30
#: Counts that every language has of anything beyond what was seen.
_SMOOTH = 0.5
UNKNOWN = "und"
_BASE_WORD, _BASE_GRAM = 0x5851F42D4C957F2D, 0xD1342543DE82EF95
_BORDER = 0x110000


def letters() -> bytes:
    """For each code point whether it is a letter."""
    return np.packbits(np.array([chr(c).isalpha() for c in range(0x110000)])).tobytes()


def lower() -> bytes:
    """Lower case of each code point of the first planes' alphabets, where it is one code point."""
    return np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x3000)], np.int32).tobytes()


class Text:
    """Words of slices of texts, by code points."""

    def __init__(self, letter_bits: bytes, lower_codes: bytes):
        self.letter = np.unpackbits(np.frombuffer(letter_bits, np.uint8)).astype(bool)
        self.lower = np.frombuffer(lower_codes, np.int32)
        self.word, self.gram = Roller(_BASE_WORD), Roller(_BASE_GRAM)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
        """(word hashes, documents, code points, words)."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        w = Words(codes, offsets, self.letter[codes])
        low = np.where(codes < len(self.lower), self.lower[np.minimum(codes, len(self.lower) - 1)], codes)
        s = self.word.prefix(mix(low.astype(np.uint64), 30))
        return mix(self.word.ranges(s, w.start, w.end), 31), w.doc_of(), low, w

    def grams(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, word numbers) of the n-grams of words with a border on both sides."""
        size = end - start + 2
        to = np.cumsum(size)
        of = np.repeat(np.arange(len(size)), size)
        place = np.arange(int(size.sum())) - np.repeat(to - size, size)
        inner = (place > 0) & (place < size[of] - 1)
        line = np.full(len(place), _BORDER, np.int64)
        line[inner] = codes[(start[of] + place - 1)[inner]]
        h = self.gram.windows(self.gram.prefix(mix(line.astype(np.uint64), 32)), n)
        whole = (place[: len(h)] + n <= size[of[: len(h)]])
        return mix(h[whole] ^ np.uint64(n), 33), of[: len(h)][whole]


def _count(letter_bits: bytes, lower_codes: bytes):
    """(language, n, hash, count); n is 0 for words."""

    def count(batches):
        text = Text(letter_bits, lower_codes)
        for batch in batches:
            langs = batch["label"].to_pylist()
            _, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                names, lang = np.unique(np.array(langs[a:b], object), return_inverse=True)
                h, doc, codes, w = text.words([t or "" for t in batch["text"].slice(a, b - a).to_pylist()])
                for k, name in enumerate(names):
                    own = lang[doc] == k
                    word, first, n = np.unique(h[own], return_index=True, return_counts=True)
                    at = np.flatnonzero(own)[first]
                    parts = [(0, word, n)]
                    for size in range(1, LONGEST + 1):
                        gram, of = text.grams(codes, w.start[at], w.end[at], size)
                        key, which = np.unique(gram, return_inverse=True)
                        parts.append((size, key, np.bincount(which, n[of], len(key)).astype(np.int64)))
                    for size, key, n_key in parts:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(key), pa.string()), pa.array(np.full(len(key), size, np.int32)), pa.array(key.view(np.int64)), pa.array(n_key)], ["lang", "n", "hash", "count"])

    return count


class Model:
    """Languages, and for words and each n-gram length sorted hashes with log frequencies."""

    def __init__(self, langs: list[str], tables: dict[int, tuple[np.ndarray, np.ndarray]], letter_bits: bytes, lower_codes: bytes):
        self.langs, self.tables, self.letter_bits, self.lower_codes = langs, tables, letter_bits, lower_codes

    def packed(self) -> tuple:
        """The model as plain values, which any worker can read."""
        return self.langs, {n: (k.tobytes(), v.tobytes()) for n, (k, v) in self.tables.items()}, self.letter_bits, self.lower_codes

    @classmethod
    def unpacked(cls, langs: list[str], tables: dict[int, tuple[bytes, bytes]], letter_bits: bytes, lower_codes: bytes) -> Model:
        read = {n: (np.frombuffer(k, np.uint64), np.frombuffer(v, np.float32).reshape(-1, len(langs))) for n, (k, v) in tables.items()} if langs else {}
        return cls(langs, read, letter_bits, lower_codes)

    def look_up(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether known, row of the table)."""
        keys = self.tables[n][0]
        if not len(keys):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return keys[at] == hashes, at

    def score_words(self, text: Text, hashes: np.ndarray, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log frequencies of each word in each language."""
        out = np.zeros((len(hashes), len(self.langs)))
        known, at = self.look_up(0, hashes)
        out[known] = self.tables[0][1][at[known]]
        left = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            gram, of = text.grams(codes, start[left], end[left], n)
            known, at = self.look_up(n, gram)
            of, values = of[known], self.tables[n][1][at[known]]
            hits = np.bincount(of, minlength=len(left))
            for k in range(len(self.langs)):
                out[left, k] += np.bincount(of, values[:, k], len(left)) / np.maximum(hits, 1)
            left = left[hits == 0]
        return out


def _first_of_each(rows: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first rows of each group; a large group is first cut down in parts of it."""
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(_PARTS))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy(*by, part).orderBy(*order))).where(F.col("place") <= most)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= most).drop("place")


def fit_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out: int = 2, sample: int = SAMPLE) -> Model:
    """The model that labelled documents outside the held-out fold give."""
    rows = docs.select(named(id_col).alias("id"), named(text_col).alias("text"), named(lang_col).cast("string").alias("label")).where("label IS NOT NULL AND text IS NOT NULL")
    rows = rows.where(F.coalesce(L.fold(F.col("id"), folds), F.lit(-1)) != held_out)
    # the sample: for each language a bound on the hash at or below which at most so many distinct rows lie
    turn = F.xxhash64("id", "text")
    first = rows.select("label", turn.alias("turn")).distinct()
    bounds = _first_of_each(first, ["label"], [F.col("turn")], sample).groupBy("label").agg(F.max("turn").alias("most")).collect()
    most = F.create_map(*[F.lit(x) for r in bounds for x in (r["label"], r["most"])]) if bounds else F.lit(None).cast("map<string,bigint>")
    rows = rows.where(turn <= most[F.col("label")])
    bits, low = letters(), lower()
    counts = rows.select("text", "label").mapInArrow(_count(bits, low), "lang string, n int, hash bigint, count bigint")
    counts = cut_lineage(counts.groupBy("n", "hash", "lang").agg(F.sum("count").alias("count")))
    often = counts.groupBy("n", "hash").agg(F.sum("count").alias("total")).where("n > 0 OR total > 1").select("n", "hash")
    top = _first_of_each(counts.join(often, ["n", "hash"], "left_semi"), ["n", "lang"], [F.desc("count"), F.col("hash")], MOST)
    # MOST rows for each n and language: bounded, whatever the corpus
    seen = counts.join(top.select("n", "hash").distinct(), ["n", "hash"], "left_semi").select("n", "hash", "lang", "count").toArrow()
    langs = sorted(set(seen["lang"].to_pylist()))
    tables = {}
    for n in range(LONGEST + 1):
        own = seen.filter(pc.equal(seen["n"], n))
        keys, row = np.unique(own["hash"].to_numpy().view(np.uint64), return_inverse=True)
        count = np.zeros((len(keys), len(langs)))
        count[row, [langs.index(x) for x in own["lang"].to_pylist()]] = own["count"].to_numpy()
        count += _SMOOTH
        tables[n] = keys, np.log(count / count.sum(0)).astype(np.float32)
    return Model(langs, tables, bits, low)


def _predict(model):
    def predict(batches):
        m = Model.unpacked(*model.value)
        text = Text(m.letter_bits, m.lower_codes)
        for batch in batches:
            _, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                h, doc, codes, w = text.words([t or "" for t in batch["text"].slice(a, b - a).to_pylist()])
                n = np.bincount(doc, minlength=b - a)
                names, score = np.full(b - a, UNKNOWN, object), np.zeros(b - a)
                if m.langs and len(h):
                    key, first, which = np.unique(h, return_index=True, return_inverse=True)
                    each = m.score_words(text, key, codes, w.start[first], w.end[first])
                    total = np.stack([np.bincount(doc, each[which, k], b - a) for k in range(len(m.langs))], 1)
                    sure = total / np.maximum(n, 1)[:, None] * np.minimum(n, SURE)[:, None]
                    p = np.exp(sure - sure.max(1, keepdims=True))
                    best = total.argmax(1)
                    some = n > 0
                    names[some] = np.array(m.langs, object)[best[some]]
                    score[some] = (p[np.arange(b - a), best] / p.sum(1))[some]
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each document."""
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    return kept.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model.packed())), L.schema_of(kept, "lang_pred string, score double"))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, fit_model(docs))
    return out.select(F.col("id").alias("doc_id"), L.is_fold(F.col("id"), 4, 2).alias("held_out"), "lang_pred", "score")
