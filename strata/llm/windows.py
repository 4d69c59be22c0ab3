"""Substring dedup: Rabin-Karp hashes of every fixed-length token window, counted in Spark.

Every window of ``width`` consecutive words of every document is hashed; a window is repeated if
the same word sequence starts earlier (smaller id, or same document and earlier start). Repeated
windows merge into maximal intervals of words, which go. All windows are judged on the input.

Plan: texts are shuffled once into homes (``exchange.py``). A home hashes all its windows, keeps
one entry for each distinct window (the earliest), and sends (hash, id) packed by bucket; a bucket
finds, for each hash, the smallest id and answers one bit for each entry; the home turns lost
windows into word intervals. A window is identified by its bucket (a second, independent hash)
and 64 bits: as buckets grow with the input, a bucket holds about a million windows at any size and
the chance that a window meets a false partner stays near 2**-44 divided by the number of buckets.

Cases: NULL and empty texts give no words and an empty text; texts with fewer than ``width`` words
keep all of them; of rows with equal ids neither is earlier than the other; an id of NULL is the
largest. A text without removals still has its words joined by one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .text import Roller, Words, byte_values, mix, slices, string_array, text_buffers

WIDTH = 20
#: Text of one home; homes whose window hashes one bucket holds.
HOME_BYTES, HOMES_IN_BUCKET = 3 << 20, 4
_BASE_WORD, _BASE_A, _BASE_B = 0x5851F42D4C957F2D, 0x2545F4914F6CDD1D, 0x9FB21C651E98DF25


class _Home:
    """All windows of a home: their hashes, buckets and the earliest of each."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        self.ids = X.ids_of(table)
        data, offsets = text_buffers(table["text"])
        byte, a, b, values = Roller(_BASE_WORD), Roller(_BASE_A), Roller(_BASE_B), byte_values()
        self.words, ha, hb, doc = [], [], [], []
        for lo, hi in slices(offsets):
            w = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            h = w.hashes(byte, values)
            at = w.window_starts(width)
            ha.append(mix(a.windows(a.prefix(h), width)[at], 2))
            hb.append(mix(b.windows(b.prefix(mix(h, 3)), width)[at], 4))
            doc.append(w.doc_of()[at] + lo)
            self.words.append((lo, hi, w, at))
        self.hash = np.concatenate([np.zeros(0, np.uint64), *ha])
        self.doc = np.concatenate([np.zeros(0, np.int64), *doc])
        bucket = (np.concatenate([np.zeros(0, np.uint64), *hb]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(self.hash)
        new = np.ones(len(order), bool)
        new[1:] = self.hash[order][1:] != self.hash[order][:-1]
        heads = np.flatnonzero(new)
        first = np.minimum.reduceat(order, heads) if len(heads) else heads
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.first = first
        #: Entries as they are sent: by bucket, then document and start.
        self.sent = np.lexsort((first, bucket[first])) if len(first) else heads
        self.sent_bucket = bucket[first[self.sent]]

    def parts(self):
        entry = self.first[self.sent]
        for b, lo, hi in X.bucket_slices(self.sent_bucket):
            yield b, self.hash[entry[lo:hi]], self.ids[self.doc[entry[lo:hi]]]

    def lost(self, answers: dict[int, bytes]) -> np.ndarray:
        """For each window, whether an earlier one exists."""
        gone = np.zeros(len(self.first), bool)
        for b, lo, hi in X.bucket_slices(self.sent_bucket):
            if b in answers:
                gone[self.sent[lo:hi]] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=hi - lo).astype(bool)
        own = self.first[self.group]  # the earliest here
        at = np.arange(len(own))
        later = (at != own) & ((self.doc == self.doc[own]) | (self.ids[self.doc] > self.ids[self.doc[own]]))
        if len(self.ids) != len(np.unique(self.ids)):  # rows with equal ids: the first start in each row stays
            same = np.flatnonzero((at != own) & (self.doc != self.doc[own]) & (self.ids[self.doc] == self.ids[self.doc[own]]))
            key = self.group[same] * (len(self.ids) + 1) + self.doc[same]
            again = np.ones(len(same), bool)
            again[np.unique(key, return_index=True)[1]] = False
            later[same[again]] = True
        return later | gone[self.group]


def _send(width: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        home = table["home"][0].as_py()
        out = {"home": [], "bucket": [], "hashes": [], "ids": [], "n": []}
        for b, hashes, ids in _Home(X.in_order(table), width, buckets).parts():
            blob, n = X.pack_small(ids)
            for k, v in zip(out, (home, b, hashes.tobytes(), blob, n), strict=True):
                out[k].append(v)
        return pa.table(out, schema=pa.schema([("home", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("n", pa.int32())]))

    return send


def _judge(table: pa.Table) -> pa.Table:
    """One bit for each entry of the bucket: whether a smaller id has the same window."""
    n = np.asarray(table["n"].combine_chunks()).astype(np.int64)
    hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()])
    ids = np.concatenate([X.unpack_small(x, k) for x, k in zip(table["ids"].to_pylist(), n, strict=True)])
    order = np.argsort(hashes)
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    lost = np.empty(len(h), bool)
    lost[order] = ids[order] > least[np.cumsum(new) - 1]
    end = np.cumsum(n)
    keep = [i for i in range(len(n)) if lost[end[i] - n[i] : end[i]].any()]
    bits = [np.packbits(lost[end[i] - n[i] : end[i]]).tobytes() for i in keep]
    return pa.table({"home": table["home"].combine_chunks().take(pa.array(keep, pa.int64())), "bucket": table["bucket"].combine_chunks().take(pa.array(keep, pa.int64())), "lost": pa.array(bits, pa.binary())})


def _apply(width: int, buckets: int):
    def apply(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = X.in_order(docs)
        home = _Home(docs, width, buckets)
        lost = home.lost(dict(zip(answers["bucket"].to_pylist(), answers["lost"].to_pylist(), strict=True)))
        n_words, n_removed, texts, seen = [], [], [], 0
        for _, _, w, at in home.words:
            edge = np.zeros(len(w) + 1, np.int64)
            gone = at[lost[seen : seen + len(at)]]
            seen += len(at)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + width, -1)
            keep = np.cumsum(edge[:-1]) == 0
            total = np.zeros(len(w) + 1, np.int64)
            np.cumsum(~keep, out=total[1:])
            n_words.append(w.counts)
            n_removed.append(np.diff(total[w.of_doc]))
            texts.append(string_array(*w.joined(keep)))
        out = {"id": docs["id"], "n_words": pa.array(np.concatenate([np.zeros(0, np.int64), *n_words])), "n_removed": pa.array(np.concatenate([np.zeros(0, np.int64), *n_removed])), "kept_text": pa.chunked_array(texts, pa.string())}
        if "extra" in docs.column_names:
            out["extra"] = docs["extra"]
        return pa.table(out)

    return apply


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, carry: list[str] | None = None, home_bytes: int = HOME_BYTES) -> DataFrame:
    """One row for each document: (id, n_words, n_removed, kept_text), and with ``carry`` a struct
    ``extra`` of those columns. ``kept_text`` is the kept words joined by one space."""
    total = X.text_bytes(docs, text_col)
    homes, buckets = X.n_homes(total, home_bytes), X.n_homes(total, HOMES_IN_BUCKET * home_bytes)
    kept = X.at_home(docs, id_col, text_col, homes, carry)
    sent = kept.select("home", "id", "text").groupBy("home").applyInArrow(X.whole_group(_send(width, buckets)), "home int, bucket int, hashes binary, ids binary, n int")
    answers = sent.groupBy("bucket").applyInArrow(X.whole_group(_judge), "home int, bucket int, lost binary")
    return X.by_home(kept, answers, _apply(width, buckets), X.with_extra(kept, "id bigint, n_words bigint, n_removed bigint, kept_text string"))


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = drop_repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
