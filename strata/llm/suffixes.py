"""Suffix-array dedup by prefix-free parsing, for byte strings that documents share.

Removes each byte covered by a ``WIDTH``-byte string that also starts in a document with a smaller id.

1. *Parse*: each position's ``WIDTH``-byte string has a trigger, its ``TRIGGER``-byte substring with
   the least rolling hash (the first of equal ones), so equal strings have equal triggers at equal
   places. Positions in a row with the same trigger are a phrase; the phrase's text runs to the end
   of its last string, so phrases overlap by WIDTH - 1 bytes and no phrase's strings need another's
   text: the phrases are prefix-free. A document's parse is its sequence of phrases.
2. *Dictionary*: Spark groups all phrases by trigger, equal ones once from each home (``exchange.py``).
   Of equal phrases the smallest document owns the text: every other document loses all strings of
   the phrase at once, which settles copies and long repeats. A trigger with one phrase is settled.
3. *Contested strings*: strings of a repeat's rim stand in different phrases with the same trigger. No
   suffix array is built for them: every WIDTH-byte string of a contested phrase is hashed and equal
   hashes are grouped (the order of unequal ones decides nothing here); equal strings are owned by
   their smallest document, and the answer goes back to all places of the parse.

Hashes are 64-bit within a trigger's bucket, and buckets grow in number with the input. Texts are
shuffled once; what goes to buckets is some 13 bytes for a phrase (about 17 positions each).

Cases: NULL texts are empty; texts of fewer than WIDTH bytes lose nothing; strings repeated within one
document only are no repeats; of rows with equal ids neither is smaller; a NULL id is the largest;
matches never cross documents; bytes are judged on the input, and may be cut within a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from .text import Roller, byte_values, mix, slices, text_buffers

WIDTH, TRIGGER = 50, 20
#: Text of one home (its phrases and contested strings are some 60 bytes for a byte at their peak), and
#: homes whose hashes one bucket holds.
HOME_BYTES, HOMES_IN_BUCKET = 3 << 20, 4
#: Low bits of a sort key that hold the place, below the hash's; longer texts are taken in stretches.
_PLACE_BITS = 28
_BASE_BYTE = 0x5851F42D4C957F2D


def triggers(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` hashes the place of the least, the first of equal ones."""
    most, runs = 1 << (_PLACE_BITS - 1), len(hashes) - span + 1
    if runs > most:  # a run's least hash is its own affair: stretches that overlap by span - 1 give the same
        return np.concatenate([triggers(hashes[a : a + most + span - 1], span) + a for a in range(0, runs, most)])
    place = np.uint64((1 << _PLACE_BITS) - 1)
    key = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= span:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < span:
        key = np.minimum(key[: len(key) - (span - size)], key[span - size :])
    return (key & place).astype(np.int64)


class _Home:
    """The parse of a home's documents, and its dictionary."""

    def __init__(self, table: pa.Table, width: int, trigger: int, buckets: int):
        self.width, self.ids = width, X.ids_of(table)
        self.data, self.offsets = text_buffers(table["text"])
        self.roller, self.values = Roller(_BASE_BYTE), byte_values()
        self.parts = list(slices(self.offsets))
        none = np.zeros(0, np.int64)
        start, count, doc, text, mark = [none], [none], [none], [none.astype(np.uint64)], [none.astype(np.uint64)]
        for a, b in self.parts:
            offsets, base, s = self._prefix(a, b)
            n = int(offsets[-1])
            if n < width:
                continue
            at = triggers(mix(self.roller.windows(s, trigger), 50), width - trigger + 1)[: n - width + 1]
            inside = np.zeros(n + 1, np.int32)  # positions whose string stays within its document
            some = np.diff(offsets) >= width
            np.add.at(inside, offsets[:-1][some], 1)
            np.add.at(inside, offsets[1:][some] - width + 1, -1)
            inside = np.cumsum(inside[: len(at)]) > 0
            new = inside.copy()
            new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
            edge = np.zeros(n, bool)
            edge[offsets[:-1][offsets[:-1] < n]] = True
            new |= edge[: len(at)] & inside
            first = np.flatnonzero(new)
            stop = np.append(first[1:], len(at))
            # a phrase ends where the next begins, or where positions are no longer inside
            total = np.concatenate([[0], np.cumsum(inside)])
            size = total[stop] - total[first]
            start.append(first + base)
            count.append(size)
            doc.append(np.searchsorted(offsets, first, "right") - 1 + a)
            text.append(mix(self.roller.ranges(s, first, first + size + width - 1), 51))
            mark.append(mix(self.roller.ranges(s, at[first], at[first] + trigger), 52))
        self.start, self.count, self.doc = np.concatenate(start), np.concatenate(count), np.concatenate(doc)
        text, mark = np.concatenate(text), np.concatenate(mark)
        # the dictionary: equal phrases once; documents are in the order of their ids, so the first owns
        _, self.owner, self.phrase = np.unique(text ^ mix(mark, 53), return_index=True, return_inverse=True)
        self.bucket = (mark[self.owner] % np.uint64(buckets)).astype(np.int64)
        self.sent = np.lexsort((self.owner, self.bucket))
        self.text, self.mark = text[self.owner], (mark[self.owner] >> np.uint64(32)).astype(np.uint32)
        self.phrase = self.phrase.astype(np.int32)
        self.count, self.doc = self.count.astype(np.int32), self.doc.astype(np.int32)

    def _prefix(self, a: int, b: int) -> tuple[np.ndarray, int, np.ndarray]:
        base = int(self.offsets[a])
        return self.offsets[a : b + 1] - base, base, self.roller.prefix(self.values[self.data[base : self.offsets[b]]])

    def owner_ids(self) -> np.ndarray:
        return self.ids[self.doc[self.owner]]

    def dictionary(self):
        """(bucket, phrase hashes, triggers, owners' ids) as they are sent."""
        ids = self.owner_ids()
        for b, lo, hi in X.bucket_slices(self.bucket[self.sent]):
            own = self.sent[lo:hi]
            yield b, self.text[own], self.mark[own], ids[own]

    def settle(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase of the dictionary: whether a smaller document has it; whether it is contested."""
        state = np.zeros(len(self.owner), np.uint8)
        for b, lo, hi in X.bucket_slices(self.bucket[self.sent]):
            if b in answers:
                bits = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=2 * (hi - lo))
                state[self.sent[lo:hi]] = bits[0::2] + 2 * bits[1::2]
        return (state & 1) > 0, state == 2

    def strings(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each string of these phrases of the dictionary, in order; phrase of each)."""
        place, count = self.start[self.owner[phrases]], self.count[self.owner[phrases]]
        of = np.repeat(np.arange(len(phrases), dtype=np.int32), count)
        at = np.arange(len(of)) + np.repeat(place - (np.cumsum(count) - count), count)
        out = np.zeros(len(at), np.uint64)
        ends = self.offsets[[b for _, b in self.parts]] if self.parts else np.zeros(0, np.int64)
        part = np.searchsorted(ends, at, "right")
        for k, (a, b) in enumerate(self.parts):
            own = np.flatnonzero(part == k)
            if len(own):
                _, base, s = self._prefix(a, b)
                out[own] = mix(self.roller.ranges(s, at[own] - base, at[own] - base + self.width), 54)
        return out, of

    def contested(self, phrases: np.ndarray, buckets: int):
        """The strings of contested phrases, each different one once, as they are sent and as they are applied."""
        h, of = self.strings(phrases)
        ids = self.owner_ids()[phrases][of]
        order = np.lexsort((ids, h))
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        group = np.empty(len(h), np.int64)
        group[order] = np.cumsum(new) - 1
        key, least = h[order][new], ids[order][new]
        bucket = (mix(key, 55) % np.uint64(buckets)).astype(np.int64)
        sent = np.lexsort((key, least, bucket))
        return of, ids, group, key, least, bucket, sent


_SENT = pa.schema([("home", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("marks", pa.binary()), ("ids", pa.binary()), ("n", pa.int32())])
_SENT_DDL = "home int, bucket int, hashes binary, marks binary, ids binary, n int"


def _send_dictionary(width: int, trigger: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        home, rows = table["home"][0].as_py(), []
        for b, text, mark, ids in _Home(X.in_order(table), width, trigger, buckets).dictionary():
            blob, n = X.pack_small(ids)
            rows.append({"home": home, "bucket": b, "hashes": text.tobytes(), "marks": mark.tobytes(), "ids": blob, "n": n})
        return pa.Table.from_pylist(rows, schema=_SENT)

    return send


def _gather(table: pa.Table):
    n = np.asarray(table["n"].combine_chunks()).astype(np.int64)
    hashes = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist())])
    ids = np.concatenate([np.zeros(0, np.int64), *(X.unpack_small(x, k) for x, k in zip(table["ids"].to_pylist(), n.tolist(), strict=True))])
    return n, hashes, ids


def _least(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each one's equals."""
    order = np.argsort(hashes)
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    out = np.empty(len(h), np.int64)
    out[order] = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1] if len(h) else ids
    return out


def _answers(table: pa.Table, n: np.ndarray, bits: np.ndarray, each: int) -> pa.Table:
    end = np.cumsum(n)
    parts = [bits[each * (e - k) : each * e] for e, k in zip(end.tolist(), n.tolist(), strict=True)]
    keep = [i for i, p in enumerate(parts) if p.any()]
    return pa.table({"home": table["home"].combine_chunks().take(pa.array(keep, pa.int64())), "bucket": table["bucket"].combine_chunks().take(pa.array(keep, pa.int64())), "answer": pa.array([np.packbits(parts[i]).tobytes() for i in keep], pa.binary())})


def _judge_dictionary(table: pa.Table) -> pa.Table:
    """Two bits for each phrase: whether a smaller document has it; whether its trigger has other phrases."""
    n, text, ids = _gather(table)
    mark = np.concatenate([np.frombuffer(x, np.uint32) for x in table["marks"].to_pylist()])
    order = np.lexsort((text, mark))
    m, t = mark[order], text[order]
    new = np.ones(len(m), bool)
    new[1:] = m[1:] != m[:-1]
    other = np.zeros(len(m), bool)
    other[1:] = (t[1:] != t[:-1]) & ~new[1:]
    group = np.cumsum(new) - 1
    bits = np.zeros((len(m), 2), np.uint8)
    bits[order, 1] = (np.bincount(group, other) > 0)[group]
    bits[:, 0] = ids > _least(text ^ mix(mark.astype(np.uint64), 56), ids)
    return _answers(table, n, bits.ravel(), 2)


def _unpack(answers: pa.Table, kind: int) -> dict[int, bytes]:
    own = answers.filter(pa.compute.equal(answers["kind"], kind)) if "kind" in answers.column_names else answers
    return dict(zip(own["bucket"].to_pylist(), own["answer"].to_pylist(), strict=True))


def _send_contested(width: int, trigger: int, buckets: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """The contested phrases' strings; and the dictionary's answers, which pass through the next step."""
        docs = X.in_order(docs)
        if not len(docs):
            return pa.Table.from_pylist([], schema=_SENT)
        home = _Home(docs, width, trigger, buckets)
        _, contested = home.settle(_unpack(answers, 0))
        _, _, _, key, least, bucket, sent = home.contested(np.flatnonzero(contested), buckets)
        rows, at = [], docs["home"][0].as_py()
        for b, lo, hi in X.bucket_slices(bucket[sent]):
            blob, n = X.pack_small(least[sent[lo:hi]])
            rows.append({"home": at, "bucket": b, "hashes": key[sent[lo:hi]].tobytes(), "marks": None, "ids": blob, "n": n})
        rows += [{"home": at, "bucket": b, "hashes": b"", "marks": x, "ids": b"", "n": 0} for b, x in _unpack(answers, 0).items()]
        return pa.Table.from_pylist(rows, schema=_SENT)

    return send


def _judge_contested(table: pa.Table) -> pa.Table:
    passing = table.filter(pa.compute.is_valid(table["marks"]))
    table = table.filter(pa.compute.is_null(table["marks"]))
    n, hashes, ids = _gather(table)
    out = _answers(table, n, (ids > _least(hashes, ids)).astype(np.uint8), 1)
    return pa.table({"home": pa.chunked_array([*out["home"].chunks, *passing["home"].chunks], pa.int32()), "bucket": pa.chunked_array([*out["bucket"].chunks, *passing["bucket"].chunks], pa.int32()), "kind": pa.array([1] * len(out) + [0] * len(passing), pa.int32()), "answer": pa.chunked_array([*out["answer"].chunks, *passing["marks"].chunks], pa.binary())})


def _apply(width: int, trigger: int, buckets: int):
    def apply(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = X.in_order(docs)
        home = _Home(docs, width, trigger, buckets)
        taken, contested = home.settle(_unpack(answers, 0))
        owner_ids = home.owner_ids()
        # phrases whose strings all go: a smaller document has the phrase, here or elsewhere
        gone = taken[home.phrase] | (home.ids[home.doc] > owner_ids[home.phrase])
        edge = np.zeros(len(home.data) + 1, np.int32)
        np.add.at(edge, home.start[gone], 1)
        np.add.at(edge, home.start[gone] + home.count[gone] + width - 1, -1)
        # single strings of contested phrases
        rim = np.flatnonzero(contested)
        if len(rim):
            of, ids, group, key, least, bucket, sent = home.contested(rim, buckets)
            lost = np.zeros(len(key), bool)
            given = _unpack(answers, 1)
            for b, lo, hi in X.bucket_slices(bucket[sent]):
                if b in given:
                    lost[sent[lo:hi]] = np.unpackbits(np.frombuffer(given[b], np.uint8), count=hi - lo).astype(bool)
            lost = lost[group] | (ids > least[group])
            number = np.full(len(home.owner), -1)
            number[rim] = np.arange(len(rim))
            begin = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(rim)))])
            own = np.flatnonzero((number[home.phrase] >= 0) & ~gone)
            size = home.count[own]
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            out = lost[np.repeat(begin[number[home.phrase[own]]], size) + step]
            at = (np.repeat(home.start[own], size) + step)[out]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + width, -1)
        removed = np.cumsum(edge[:-1]) > 0
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        first = home.offsets[:-1][home.offsets[:-1] < len(removed)]
        opens[first] = removed[first]
        per = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[home.offsets])
        size = np.diff(home.offsets)
        n_removed = per(removed)
        kept = np.concatenate([[0], np.cumsum(size - n_removed)]).astype(np.int32)
        out = {"id": docs["id"], "n_bytes": pa.array(size), "n_removed": pa.array(n_removed), "n_spans": pa.array(per(opens)), "kept": pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(kept.tobytes()), pa.py_buffer(home.data[~removed].tobytes())])}
        if "extra" in docs.column_names:
            out["extra"] = docs["extra"]
        return pa.table(out)

    return apply


def drop_shared_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, trigger: int = TRIGGER, carry: list[str] | None = None, home_bytes: int = HOME_BYTES) -> DataFrame:
    """One row for each document: (id, n_bytes, n_removed, n_spans, kept), and with ``carry`` a struct
    ``extra`` of those columns. ``kept`` is the remaining bytes."""
    total = X.text_bytes(docs, text_col)
    homes, buckets = X.n_homes(total, home_bytes), X.n_homes(total, HOMES_IN_BUCKET * home_bytes)
    kept = X.at_home(docs, id_col, text_col, homes, carry)
    plain = kept.select("home", "id", "text")
    sent = plain.groupBy("home").applyInArrow(_send_dictionary(width, trigger, buckets), _SENT_DDL)
    settled = sent.groupBy("bucket").applyInArrow(_judge_dictionary, "home int, bucket int, answer binary")
    rims = X.by_home(plain, settled, _send_contested(width, trigger, buckets), _SENT_DDL)
    answers = rims.groupBy("bucket").applyInArrow(_judge_contested, "home int, bucket int, kind int, answer binary")
    return X.by_home(kept, answers, _apply(width, trigger, buckets), X.with_extra(kept, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"))


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = drop_shared_strings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
