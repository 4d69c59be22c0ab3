"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how usual each pair is.

Both tokenizers encode a space and the text; a token covers a range of those bytes. For a slice of documents
two calls of ``pandas.merge_asof``, keyed by document, find for each token start of one side the other
side's token that covers it; the union of both directions is all pairs of overlapping tokens (links), for of two
overlapping ranges one starts within the other. Places where tokens of both sides end cut the tokens into groups.

Plan: one pass over the texts writes a row for each document with its groups and, packed, its distinct
id pairs with their occurrences; the table lies in the shared folder, so texts are encoded once. Rows are then
dealt into homes of about ``HOME_LINKS`` links; a home adds up in how many of its documents each pair is linked
and sends every pair once to a bucket of the pair's hash, so a pair that most documents hold arrives once from
each home. Buckets answer each home with the corpus-wide counts. The highest count of each id of the
first tokenizer is an aggregate with as many rows as its vocabulary has ids, which bounds what is broadcast.

The byte-level tokenizer is encoded by ``tiktoken`` with the ranks of the tokenizer's own file, which is refused
unless its ids are in the order of its merges; results are the same as the ``tokenizers`` library's (a test compares
them over all of Unicode). The other one is encoded by ``sentencepiece``.

Cases: NULL and empty texts, and texts whose tokens' bytes are not the space and the text (U+2581 in a text),
have no tokens, groups or links; special tokens that a text spells out are plain text; rows with equal
ids are documents of their own and count as such; an id is carried as it is.
"""

from __future__ import annotations

import json
import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import checkpoint_root

from . import exchange as X
from .bpe import byte_characters
from .exchange import batch_by_batch, extra, named, uncarried, whole_group, with_extra
from .text import mix, slices, text_buffers

#: Links of one home, and homes whose pairs one bucket counts.
HOME_LINKS, HOMES_A_BUCKET = 3_000_000, 4
#: Text that is aligned together: its tokens, their overlaps and pairs take about 90 times its bytes.
SLICE_BYTES = 1 << 18
#: An id pair is one number: the first side's id, then 20 bits of the other's.
_BITS = 20
#: Fixed value: how the byte-level tokenizer cuts text into words.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level BPE tokenizer file: its ids and the bytes of each."""

    def __init__(self, text: str):
        import tiktoken

        spec = json.loads(text)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in byte_characters().items()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        merged = [spec["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("a tokenizer whose ids are not in the order of its merges is not encoded")
        self.bytes = {i: b for b, i in ranks.items()}
        self.encode_one = tiktoken.Encoding("bytes", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encode_one(" " + t) for t in texts]


class Pieces:
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Side:
    """The tokens of some documents: ids, documents, and the bytes they cover, counted over all the documents."""

    def __init__(self, ids: list[list[int]], lengths: np.ndarray, base: np.ndarray):
        self.count = np.array([len(x) for x in ids], np.int64)
        self.doc = np.repeat(np.arange(len(ids)), self.count)
        self.ids = np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in ids)])
        size = lengths[self.ids]
        self.end = np.cumsum(size)
        self.start = self.end - size
        assert not len(size) or self.end[-1] == base[-1]

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"at": self.start, "doc": self.doc, name: np.arange(len(self.ids))})


def overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j) of tokens that share a byte: the token of the other side that covers each token's start."""
    if not len(a.ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = a.frame("i"), b.frame("j")
    over_a = pd.merge_asof(left, right, on="at", by="doc")
    over_b = pd.merge_asof(right, left, on="at", by="doc")
    over_b = over_b[a.start[over_b["i"].to_numpy()] != over_b["at"].to_numpy()]  # equal starts are found twice
    return np.concatenate([over_a["i"], over_b["i"]]).astype(np.int64), np.concatenate([over_a["j"], over_b["j"]]).astype(np.int64)


class _Texts:
    """What stands for each token of either side in a listing of groups, with what follows it there."""

    def __init__(self, n_a: int, n_b: int):
        a, b = list(map(str, range(n_a))), list(map(str, range(n_b)))
        self.table = [*(x + "," for x in a), *(x + "|" for x in a), *(x + "," for x in b), *(x + ";" for x in b), *b]
        self.at = np.cumsum([0, n_a, n_a, n_b, n_b])

    def listing(self, a: Side, b: Side) -> tuple[list[str], np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of each document, and its number of groups."""
        n = len(a.count)
        ends = a.end[np.isin(a.end, b.end, assume_unique=True)]
        group_a, group_b = np.searchsorted(ends, a.end), np.searchsorted(ends, b.end)
        last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(group_a)]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(group_b)]
        final = np.append(b.doc[1:] != b.doc[:-1], True)[: len(b.doc)]
        code = np.empty(len(group_a) + len(group_b), np.int64)
        code[np.arange(len(group_a)) + np.searchsorted(group_b, group_a)] = a.ids + self.at[last_a.astype(np.int64)]
        code[np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")] = b.ids + self.at[2 + last_b + final]
        shown = list(map(self.table.__getitem__, code.tolist()))
        cut = np.concatenate([[0], np.cumsum(a.count + b.count)]).tolist()
        per_doc = np.bincount(a.doc[last_a], minlength=n) if len(a.doc) else np.zeros(n, np.int64)
        return ["".join(shown[x:y]) for x, y in zip(cut, cut[1:], strict=False)], per_doc


def _packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    return X.pack_small(np.concatenate([pairs, times]))[0] if len(pairs) else b""


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    both = X.unpack_small(blob, 2 * n)
    return both[:n], both[n:]


class _Slices:
    """Aligns some documents at a time; nothing of a slice but its rows is left when the next one begins."""

    def __init__(self, byte_level: str, pieces: bytes):
        self.sides = ByteLevel(byte_level), Pieces(pieces)
        self.lengths = [np.array([len(s.bytes.get(i, b"")) for i in range(max(s.bytes) + 1)], np.int64) for s in self.sides]
        self.texts = _Texts(*(len(x) for x in self.lengths))

    def tokens(self, given: list[str]) -> tuple[Side, Side]:
        """Both sides' tokens; none of a text whose tokens' bytes are not the space and the text."""
        ids = [s.encode(given) for s in self.sides]
        base = np.zeros(len(given) + 1, np.int64)
        for k, t in enumerate(given):
            want = b" " + t.encode() if t else b""
            if not t or any(b"".join(map(s.bytes.__getitem__, x[k])) != want for s, x in zip(self.sides, ids, strict=True)):
                ids[0][k], ids[1][k], want = [], [], b""
            base[k + 1] = base[k] + len(want)
        a, b = (Side(x, size, base) for x, size in zip(ids, self.lengths, strict=True))
        return a, b

    def align(self, part: pa.RecordBatch) -> pa.RecordBatch:
        a, b = self.tokens([t or "" for t in part["text"].to_pylist()])
        n = len(part)
        i, j = overlaps(a, b)
        doc = a.doc[i]
        n_links = np.bincount(doc, minlength=n).astype(np.int64)
        key = doc << 2 * _BITS | a.ids[i] << _BITS | b.ids[j]
        del i, j, doc
        key, times = np.unique(key, return_counts=True)
        cut = np.searchsorted(key, np.arange(n + 1) << 2 * _BITS)
        pair = key & ((1 << 2 * _BITS) - 1)
        blobs = [_packed(pair[x:y], times[x:y]) for x, y in zip(cut.tolist(), cut[1:].tolist(), strict=False)]
        del key, times, pair
        listing, n_groups = self.texts.listing(a, b)
        out = {
            "id": part["id"], "n_a": pa.array(a.count), "n_b": pa.array(b.count), "n_groups": pa.array(n_groups.astype(np.int64)),
            "n_links": pa.array(n_links), "groups": pa.array(listing, pa.string()),
            "n_pairs": pa.array(np.diff(cut), pa.int64()), "pairs": pa.array(blobs, pa.binary()),
        }
        return pa.RecordBatch.from_pydict(out)


def _align(tokenizers):
    def align(batches):
        own = _Slices(*tokenizers.value)
        X.give_back()  # what reading the tokenizers' files took
        for batch in batches:
            _, offsets = text_buffers(batch["text"])
            for lo, hi in slices(offsets, SLICE_BYTES):
                yield own.align(batch.slice(lo, hi - lo))

    return align


def align(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: (id, n_a, n_b, n_groups, n_links, groups, n_pairs, pairs). ``groups`` lists the ids of
    each group, ``a1,a2|b1;a3|b2,b3``; ``pairs`` are the document's distinct linked id pairs and their occurrences."""
    with open(byte_level, encoding="utf-8") as f, open(pieces, "rb") as g:
        tokenizers = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    fields = StructType.fromDDL("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, n_pairs bigint, pairs binary")
    return kept.mapInArrow(batch_by_batch(_align(tokenizers)), StructType([kept.schema["id"], *fields]))


class _Home:
    """The distinct pairs of a home's documents by bucket, and in how many documents each is."""

    def __init__(self, table: pa.Table, buckets: int):
        own = [_unpacked(x, n) for x, n in zip(table["pairs"].to_pylist(), table["n_pairs"].to_pylist(), strict=True)]
        self.sizes = [len(p) for p, _ in own]
        self.flat = np.concatenate([np.zeros(0, np.int64), *(p for p, _ in own)])
        self.times = np.concatenate([np.zeros(0, np.int64), *(t for _, t in own)])
        pairs, self.of, docs = np.unique(self.flat, return_inverse=True, return_counts=True)
        bucket = (mix(pairs.astype(np.uint64), 21) % np.uint64(buckets)).astype(np.int64)
        self.sent = np.argsort(bucket, kind="stable")
        self.slices = X.bucket_slices(bucket[self.sent])
        self.pairs, self.docs = pairs, docs


def _send(buckets: int):
    def send(table: pa.Table) -> pa.Table:
        home = _Home(table, buckets)
        rows = [(b, hi - lo, _packed(home.pairs[home.sent[lo:hi]], home.docs[home.sent[lo:hi]])) for b, lo, hi in home.slices]
        k, n, blobs = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"home": pa.array([table["home"][0].as_py()] * len(rows), pa.int32()), "bucket": pa.array(k, pa.int32()), "n": pa.array(n, pa.int64()), "sent": pa.array(blobs, pa.binary())})

    return send


def _count(table: pa.Table) -> pa.Table:
    """For each home the corpus-wide count of each pair that it sent, in that order; and, in a row without a home,
    the highest count of each first id in the bucket."""
    homes, sizes = table["home"].to_pylist(), table["n"].to_pylist()
    own = [_unpacked(x, n) for x, n in zip(table["sent"].to_pylist(), sizes, strict=True)]
    pairs, of = np.unique(np.concatenate([p for p, _ in own]), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, of, np.concatenate([d for _, d in own]))
    first = pairs >> _BITS
    heads = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    cut = np.cumsum([0, *sizes]).tolist()
    blobs = [X.pack_small(counts[of[x:y]])[0] for x, y in zip(cut, cut[1:], strict=False)]
    out = {
        "home": pa.array([*homes, None], pa.int32()), "bucket": pa.array([table["bucket"][0].as_py()] * (len(homes) + 1), pa.int32()),
        "n": pa.array([*sizes, len(heads)], pa.int64()), "counts": pa.array([*blobs, _packed(first[heads], np.maximum.reduceat(counts, heads))], pa.binary()),
    }
    return pa.table(out)


def _highest(batches):
    for batch in batches:
        for blob, n in zip(batch["counts"].to_pylist(), batch["n"].to_pylist(), strict=True):
            first, most = _unpacked(blob, n)
            yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(most)], ["a", "most"])


def _apply(buckets: int, highest):
    def apply(docs: pa.Table, answers: pa.Table) -> pa.Table:
        home = _Home(docs, buckets)
        answer = {b: X.unpack_small(x, n) for b, n, x in zip(*(answers[c].to_pylist() for c in ("bucket", "n", "counts")), strict=True)}
        counts = np.zeros(len(home.pairs), np.int64)
        for b, lo, hi in home.slices:
            counts[home.sent[lo:hi]] = answer[b]
        first, most = highest.value
        best = counts == most[np.searchsorted(first, home.pairs >> _BITS)] if len(counts) else counts
        doc = np.repeat(np.arange(len(home.sizes)), home.sizes)
        total = np.zeros((2, len(home.sizes)), np.int64)
        np.add.at(total[0], doc, home.times * best[home.of])
        np.add.at(total[1], doc, home.times * counts[home.of])
        out = {"n_best": pa.array(total[0]), "count_sum": pa.array(total[1]), "extra": docs["extra"]}
        return pa.table(out)

    return apply


def score_links(aligned: DataFrame, home_links: int = HOME_LINKS) -> DataFrame:
    """The rows of ``align`` without ``pairs``, and for each: ``n_best``, its links whose id pair is linked in as many
    documents as any pair of that first id, and ``count_sum``, that number of documents added up over its links."""
    spark = aligned.sparkSession
    folder = f"{checkpoint_root(spark)}/alignment/{uuid.uuid4().hex}"
    kept = [c for c in aligned.columns if c not in ("pairs", "n_pairs")]
    rows = aligned.select(F.monotonically_increasing_id().alias("row"), "n_links", "n_pairs", "pairs", extra(kept))
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    links = rows.agg(F.coalesce(F.sum("n_links"), F.lit(0))).first()[0]
    homes = max(1, math.ceil(links / home_links))
    buckets = max(1, math.ceil(homes / HOMES_A_BUCKET))
    rows = rows.withColumn("home", F.pmod(F.xxhash64("row"), F.lit(homes)).cast("int"))
    sent = rows.select("home", "n_pairs", "pairs").groupBy("home").applyInArrow(whole_group(_send(buckets)), "home int, bucket int, n bigint, sent binary")
    answers = sent.groupBy("bucket").applyInArrow(whole_group(_count), "home int, bucket int, n bigint, counts binary")
    answers.write.parquet(f"{folder}/answers")
    answers = spark.read.parquet(f"{folder}/answers")
    most = answers.where("home IS NULL").select("n", "counts").mapInArrow(batch_by_batch(_highest), "a bigint, most bigint")
    most = most.groupBy("a").agg(F.max("most").alias("most")).orderBy("a").toPandas()  # a row for each id of a vocabulary
    highest = spark.sparkContext.broadcast((most["a"].to_numpy(), most["most"].to_numpy()))
    asked = rows.select("home", "n_pairs", "pairs", "extra")
    scored = X.by_home(asked, answers.where("home IS NOT NULL"), _apply(buckets, highest), with_extra(rows, "n_best bigint, count_sum bigint"))
    return scored.select(*uncarried(scored, kept), "n_best", "count_sum")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def digests(aligned: DataFrame) -> DataFrame:
    sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    return aligned.select("id", "n_a", "n_b", "n_groups", "n_links", "n_pairs", "pairs", sha)


def op11_cross_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    aligned = align(spark.read.parquet(f"{sf_dir}/documents.parquet"), *tokenizer_paths())
    scored = score_links(digests(aligned))
    return scored.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
