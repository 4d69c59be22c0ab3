"""N-gram Jaccard join by T-occurrence search (DivideSkip) over distributed inverted lists.

A document's set is its distinct word shingles. Documents a and b link when
``100 * |a & b| >= 80 * |a | b|``, so they share at least T = ceil(4/5 * max(|a|, |b|)) shingles.
DivideSkip divides the inverted lists of a set's shingles into L long ones and the rest: a partner must occur in T - L
of the short lists at least, and is looked up in the long ones by binary search. Here a set is in its
|a| - T + c rarest short lists, c = 1 + |a| // 20, and any partner is in c of them; a set with fewer short lists is in
all of them, with c = T - L, so that the lists of a site's template are not touched although most pages
have it. (For a pair the smaller c of the two counts.) Only sets of which T shingles or more are in long lists go
into these too. In place of a heap, lists are merged by sorting, and in place of candidate by candidate, the
sets of candidate pairs are probed whole; both give what the heap and the probes would.

1. *Statistics*: one pass over all texts gives each document's set size and a 64-bit set key, and
   counts, in slices, shingles that several sets hold. The ``HEAVY`` most frequent ones (a fixed
   bound, 4 MB broadcast) come last in the order of shingles, by count; all others are ordered
   by hash. Those counted over ``SHORT`` times are the long lists known beforehand; others turn out long when they
   are merged. Any order and any choice of long lists give the same links; these keep the lists short.
2. *Merging short lists*: each set sends its rarest shingles to hash buckets, packed, sets that are
   equal once for each slice of texts. A bucket merges its lists by sorting. Short lists give pairs
   whose sizes are in reach of each other, and Spark counts the occurrences of each pair over all
   buckets; a pair with fewer than c - min(l_a, l_b) of them cannot link, where l is the number of
   a set's lists that turned out long. A set that is also in long lists has all its short ones, so that the other set's c
   holds for the pair. Equal sets are one set and need no link at all.
   By the same bound a pair needs its long lists only if min(l_a, l_b) >= min(c_a, c_b), or else short lists have it:
   of a long list those members stay whose l reaches the least c of a member with l >= c, and none if
   there is no such member. So lists that are long by chance, as common phrases make them in a large corpus, are dropped.
3. *Sketches*: the parity of a set's shingles in at least as many cells as it has shingles (a power of two, 512 or more),
   made in the first pass. A sketch folds to half its cells by XOR of its halves. The Hamming distance of two is at
   most ``|a ^ b|``, which is at most (|a| + |b|) / 9 for sets that link, and is more than that for most sets below
   a similarity of about 0.74, however large they are. All pairs pass this bound before a set is read.
4. *Two rounds*: round 1 pairs each set with its smallest partner from the short lists and with the
   pivot of each of its long lists, the member with the most company in long lists (the original of a
   group of near copies has most of what the others have). Round 2 takes all other pairs whose sets
   are still apart: those of the short lists, and in long lists that hold several components every
   pair, in blocks of ``BLOCK`` members, that passes the size bound and the sketch bound. Every pair of every list is so
   checked, connected or excluded by a bound that holds for all links, so components are exact, while what is emitted are
   pairs that are near.
5. *Probing*: in each round the sets of the pairs that it tries (only those) are written once; the
   smaller set's shingles are looked up in the larger one's by binary search.
6. Components over set keys (``components.py``), each named by its smallest document id.

Cases: NULL, empty and wordless texts have no shingles, link with nothing and are their own
component; fewer than ``n`` words make one shingle; equal texts link; rows with equal ids are one
node for ``component_id``; a NULL id never names a component unless no row of it has an id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

from . import exchange as X
from .components import components
from .text import Roller, Words, byte_values, lower_table, mix, slices, text_buffers

N = 5
#: Frequent shingles that are ordered by their count and broadcast; a shingle below it is ordered by hash.
HEAVY = 262_144
#: Sets that a short list holds at most.
SHORT = 32
#: Marks the count of a set that is in long lists because they are most of what it has.
ONLY_LONG = 1 << 20
#: Members of a long list that are compared in one task.
BLOCK = 4096
#: A shingle counts as frequent in a slice if so many of its sets hold it.
HEAVY_IN_SLICE = 2
#: Cells of a sketch at least.
_CELLS = 512
#: Text hashed together; equal sets in it are sent once.
SLICE_BYTES = 4 << 20

_BASE_WORD, _BASE_SHINGLE = 0x5851F42D4C957F2D, 0xD1342543DE82EF95


class _Sets:
    """Distinct shingle hashes, ascending, of each document of a batch, and a key of each set."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, n: int, rollers: tuple[Roller, Roller]):
        self.sets: list[np.ndarray] = []
        for a, b in slices(offsets):
            self._add(Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), n, *rollers)
        self.size = np.array([len(x) for x in self.sets], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *self.sets])
        total = np.zeros(len(flat) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(flat, 7), out=total[1:])
            cut = np.concatenate([[0], np.cumsum(self.size)])
            key = total[cut[1:]] - total[cut[:-1]]
        self.key = mix(key ^ mix(self.size.astype(np.uint64), 8), 9).view(np.int64)

    def _add(self, w: Words, n: int, words: Roller, shingles: Roller) -> None:
        s = shingles.prefix(w.hashes(words, byte_values(), lower_table()))
        size = np.minimum(w.counts, n)
        per = np.where(w.counts > 0, w.counts - size + 1, 0)
        doc = np.repeat(np.arange(len(per)), per)
        first = np.repeat(w.of_doc[:-1], per) + np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
        h = mix(shingles.ranges(s, first, first + size[doc]), 5)
        h ^= mix(size[doc].astype(np.uint64), 6)  # a short text's only shingle differs from longer ones
        end = np.cumsum(per)
        self.sets += [np.unique(h[b - k : b]) for b, k in zip(end.tolist(), per.tolist(), strict=True)]


def _batches(batches, n: int):
    """(ids, sets) in slices of about SLICE_BYTES."""
    rollers = Roller(_BASE_WORD), Roller(_BASE_SHINGLE)
    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        for a, b in slices(offsets, SLICE_BYTES):
            yield batch["id"].slice(a, b - a), _Sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n, rollers)


def _distinct(s: _Sets) -> np.ndarray:
    """The first document of each different non-empty set."""
    _, first = np.unique(s.key, return_index=True)
    return first[s.size[first] > 0]


def _sketch(s: np.ndarray) -> bytes:
    """Parity of a set's shingles in cells by their lowest bits."""
    cells = max(_CELLS, 1 << (len(s) - 1).bit_length()) if len(s) else _CELLS
    return np.packbits(np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1).tobytes()


def _folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of ``width`` bytes or more as rows of that width."""
    out = np.empty((len(sketches), width), np.uint8)
    size = np.array([len(x) for x in sketches], np.int64)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        rows = np.frombuffer(b"".join([sketches[i] for i in at.tolist()]), np.uint8).reshape(len(at), n)
        while n > width:
            n //= 2
            rows = rows[:, :n] ^ rows[:, n:]
        out[at] = rows
    return out.view(np.uint64)


def _survey(n: int):
    """Rows of documents (id, n_shingles, set key, sketch), and of shingles that several sets of a slice hold.
    An id is whatever the rows have in that column."""

    def survey(batches):
        for ids, s in _batches(batches, n):
            yield pa.RecordBatch.from_arrays([ids, pa.array(s.size), pa.array(s.key), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64()), pa.array([_sketch(x) for x in s.sets], pa.binary())], names)
            own = _distinct(s)
            h = np.sort(np.concatenate([np.zeros(0, np.uint64), *(s.sets[i] for i in own.tolist())]))
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            count = np.diff(np.append(new, len(h)))
            many = count >= HEAVY_IN_SLICE
            k = int(many.sum())
            yield pa.RecordBatch.from_arrays([pa.nulls(k, ids.type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(h[new[many]].view(np.int64)), pa.array(count[many]), pa.nulls(k, pa.binary())], names)

    names = ["id", "n_shingles", "key", "shingle", "count", "sketch"]
    return survey


def _rarest(s: np.ndarray, heavy: np.ndarray, rank: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles whose lists a set is in, and how many of them a partner must have (c): the first |s| - T + c in the
    order of shingles that are not long. With fewer of those all of them, and c = T - L; with L >= T long ones too,
    and ``ONLY_LONG`` is added to c."""
    most = len(s) - -(-4 * len(s) // 5)  # |s| - T
    c = 1 + len(s) // 20
    want = most + c
    if not len(heavy):
        return s[:want], c
    at = np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)
    light = heavy[at] != s
    own = s[light]
    if len(own) >= want:
        return own[:want], c
    order = np.argsort(rank[at[~light]], kind="stable")
    rest, is_long = s[~light][order], long[at[~light]][order]
    own = np.concatenate([own, rest[~is_long]])
    if len(own) >= want:
        return own[:want], c
    if len(own) > most:
        return own, len(own) - most
    return np.concatenate([own, rest[is_long]])[:want], c + ONLY_LONG


def _short_lists(n: int, buckets: int, frequent):
    """Packed entries (shingle, set key, set size) of a slice, by bucket."""

    def send(batches):
        heavy, rank, long = (np.frombuffer(x, t) for x, t in zip(frequent.value, (np.uint64, np.int64, np.bool_), strict=True))
        for _, s in _batches(batches, n):
            own = _distinct(s)
            parts = [_rarest(s.sets[i], heavy, rank, long) for i in own.tolist()]
            shingle = np.concatenate([np.zeros(0, np.uint64), *(p for p, _ in parts)])
            doc = np.repeat(own, [len(p) for p, _ in parts])
            need = np.repeat(np.array([c for _, c in parts], np.int32), [len(p) for p, _ in parts])
            bucket = (mix(shingle, 12) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows = {"bucket": [], "shingles": [], "keys": [], "sizes": [], "needs": []}
            for b, lo, hi in X.bucket_slices(bucket[order]):
                o = order[lo:hi]
                for k, v in zip(rows, (b, shingle[o].tobytes(), s.key[doc[o]].tobytes(), s.size[doc[o]].astype(np.int32).tobytes(), need[o].tobytes()), strict=True):
                    rows[k].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int32()), ("shingles", pa.binary()), ("keys", pa.binary()), ("sizes", pa.binary()), ("needs", pa.binary())]))

    return send


#: Columns of a bucket's packed answer, with their types.
_PAIRS = {"a": np.int64, "b": np.int64, "need": np.int32, "n": np.int32}
_LONG = {"list": np.int64, "key": np.int64, "size": np.int32}
_IN_LONG = {"member": np.int64, "lists": np.int32, "company": np.int64, "c": np.int32}


def _merge_lists(table: pa.Table) -> pa.Table:
    """Merges a bucket's lists: occurrences of pairs in short lists; members of long ones, by size."""
    join = lambda c, t: np.concatenate([np.zeros(0, t), *(np.frombuffer(x, t) for x in table[c].to_pylist())])
    shingle, key, size, need = join("shingles", np.uint64), join("keys", np.int64), join("sizes", np.int32).astype(np.int64), join("needs", np.int32).astype(np.int64)
    # entries of shingles that occur twice or more
    order = np.argsort(shingle)
    h = shingle[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    many = (np.diff(np.append(np.flatnonzero(new), len(h))) > 1)[np.cumsum(new) - 1]
    order = order[many]
    shingle, key, size, need = shingle[order], key[order], size[order], need[order]
    order = np.lexsort((key, size, shingle))
    shingle, key, size, need = shingle[order], key[order], size[order], need[order]
    once = np.ones(len(key), bool)
    once[1:] = (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1]) | (size[1:] != size[:-1])
    shingle, key, size, need = shingle[once], key[once], size[once], need[once]
    begin = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]])) if len(shingle) else np.zeros(0, np.int64)
    length = np.diff(np.append(begin, len(shingle)))
    own = np.repeat(length, length)
    out = _short_pairs(*(x[own <= SHORT] for x in (shingle, key, size, need)))
    member, first, at, lists = np.unique(key[own > SHORT], return_index=True, return_inverse=True, return_counts=True)
    company = np.bincount(at, own[own > SHORT], len(member))
    out |= {"member": member, "lists": lists, "company": company, "c": need[own > SHORT][first] % ONLY_LONG} | _long_lists(key, size, begin[length > SHORT], length[length > SHORT])
    types = _PAIRS | _LONG | _IN_LONG
    return pa.table({c: pa.array([out[c].astype(t).tobytes()], pa.binary()) for c, t in types.items()})


def _short_pairs(shingle: np.ndarray, key: np.ndarray, size: np.ndarray, needs: np.ndarray) -> dict[str, np.ndarray]:
    a, b, need = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = np.arange(len(shingle))
    for gap in range(1, SHORT):
        at = at[: np.searchsorted(at, len(shingle) - gap)]
        at = at[(shingle[at] == shingle[at + gap]) & (5 * size[at] >= 4 * size[at + gap])]  # sizes ascend: nothing further is in reach either
        if not len(at):
            break
        a.append(np.minimum(key[at], key[at + gap]))
        b.append(np.maximum(key[at], key[at + gap]))
        need.append(np.minimum(needs[at], needs[at + gap]) % ONLY_LONG)
    a, b, need = np.concatenate(a), np.concatenate(b), np.concatenate(need)
    order = np.lexsort((b, a))
    a, b, need = a[order], b[order], need[order]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    return {"a": a[new], "b": b[new], "need": need[new], "n": np.diff(np.append(new, len(a)))}


def _long_lists(key: np.ndarray, size: np.ndarray, begin: np.ndarray, length: np.ndarray) -> dict[str, np.ndarray]:
    """(list, key, size) of members; of lists with equal members one is kept."""
    total = np.zeros(len(key) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(key.view(np.uint64), 13), out=total[1:])
        members = total[begin + length] - total[begin]
    _, kept = np.unique(members, return_index=True)
    begin, length, members = begin[kept], length[kept], members[kept]
    which = np.repeat(np.arange(len(length)), length)
    at = begin[which] + np.arange(len(which)) - (np.cumsum(length) - length)[which]
    return {"list": members.view(np.int64)[which], "key": key[at], "size": size[at]}


def _unpacked(packed: DataFrame, columns: dict) -> DataFrame:
    """Rows of the columns that buckets answered in packed form."""

    def unpack(batches):
        for batch in batches:
            for i in range(len(batch)):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(batch[c][i].as_py(), t)) for c, t in columns.items()], list(columns))

    return packed.select(*columns).mapInArrow(X.batch_by_batch(unpack), ", ".join(f"{c} {'bigint' if t is np.int64 else 'int'}" for c, t in columns.items()))


def _sets_of(n: int):
    def sets(batches):
        for _, s in _batches(batches, n):
            yield pa.RecordBatch.from_arrays([pa.array(s.key), pa.array([x.tobytes() for x in s.sets], pa.binary())], ["key", "shingles"])

    return sets


def _probe(batches):
    """Pairs of sets that link: the smaller set's shingles are searched in the larger one's."""
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common = int((large[at] == small).sum())
            if 100 * common >= 80 * (len(x) + len(y) - common):
                keep.append(i)
        out = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([out["a"], out["b"]], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    """One row for each document: (id, n_shingles, component_id)."""
    named_rows = _named_rows(docs, id_col, text_col, n)
    least = named_rows.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    return named_rows.join(least, "component", "left").select("id", "n_shingles", F.coalesce("least", "id").alias("component_id"))


def grouped_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    """One row for each document: (id, text_hash, n_shingles, component), where text_hash is Spark's xxhash64
    of the whole text and the component is named by a set key (NULL without shingles), so that NULL and
    repeated ids are told apart."""
    return _named_rows(docs, id_col, text_col, n, F.xxhash64(X.named(text_col)))


def _named_rows(docs: DataFrame, id_col: str, text_col: str, n: int, text_hash: Column | None = None) -> DataFrame:
    """(id[, text_hash], n_shingles, component) of each document."""
    spark = docs.sparkSession
    kept = docs.select(X.named(id_col).cast("long").alias("id"), X.named(text_col).alias("text"))
    buckets = X.n_homes(X.text_bytes(docs, text_col))
    if text_hash is None:
        read, id_type, own = kept, "bigint", ["id"]
    else:
        both = F.struct(X.named(id_col).cast("long").alias("id"), text_hash.alias("text_hash"))
        read, id_type, own = docs.select(both.alias("id"), X.named(text_col).alias("text")), "struct<id:bigint,text_hash:bigint>", ["id.id", "id.text_hash"]
    surveyed = cut_lineage(read.mapInArrow(X.batch_by_batch(_survey(n)), f"id {id_type}, n_shingles bigint, key bigint, shingle bigint, count bigint, sketch binary"))
    documents = surveyed.where("shingle IS NULL")
    rows = documents.select(*own, "n_shingles", "key")
    most = surveyed.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "shingle").limit(HEAVY).toArrow()
    heavy = most["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(heavy)
    rank = np.empty(len(heavy), np.int64)
    rank[:] = np.arange(len(heavy))[::-1][order]  # the rarest of them first
    long = most["count"].to_numpy()[order] > SHORT
    frequent = spark.sparkContext.broadcast((heavy[order].tobytes(), rank.tobytes(), long.tobytes()))

    sent = kept.mapInArrow(X.batch_by_batch(_short_lists(n, buckets, frequent)), "bucket int, shingles binary, keys binary, sizes binary, needs binary")
    packed = cut_lineage(sent.groupBy("bucket").applyInArrow(X.whole_group(_merge_lists), ", ".join(f"{c} binary" for c in (_PAIRS | _LONG | _IN_LONG))))
    in_long = cut_lineage(_unpacked(packed, _IN_LONG).groupBy("member").agg(F.sum("lists").alias("lists"), F.sum("company").alias("company"), F.max("c").alias("c")))
    lists, pairs = _lists(packed, in_long), _candidates(packed, in_long)

    members = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(lists.select("key")).distinct()
    sketches = documents.select("key", F.col("n_shingles").alias("size"), "sketch").join(members, "key", "left_semi")
    sketches = cut_lineage(sketches.dropDuplicates(["key"]))

    def linked(tries: DataFrame) -> DataFrame:
        """The pairs that link, of a written table; their sets come from one document of each."""
        members = tries.select(F.col("a").alias("key")).union(tries.select("b")).distinct()
        example = X.written(rows.join(members, "key", "left_semi").groupBy("key").agg(F.min("id").alias("id")))
        wanted = example.select(F.col("id").alias("wanted"))
        texts = kept.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
        sets = texts.mapInArrow(X.batch_by_batch(_sets_of(n)), "key bigint, shingles binary")
        return _linked(tries, cut_lineage(sets.join(example.select("key"), "key", "left_semi")))

    groups = _groups(_near_pairs(pairs, sketches), lists, sketches, linked)
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "key")).alias("component")
    return rows.join(groups.withColumnRenamed("node", "key"), "key", "left").select(*[c.split(".")[-1] for c in own], "n_shingles", component)


def _candidates(packed: DataFrame, in_long: DataFrame) -> DataFrame:
    """(a, b) of sets that occur together often enough in short lists, given how many long lists each is in."""
    pairs = _unpacked(packed, _PAIRS).groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    for c in ("a", "b"):
        pairs = pairs.join(in_long.select(F.col("member").alias(c), F.col("lists").alias(f"long_{c}")), c, "left")
    return cut_lineage(pairs.where("n >= need - least(coalesce(long_a, 0), coalesce(long_b, 0))").select("a", "b"))


def _lists(packed: DataFrame, in_long: DataFrame) -> DataFrame:
    """(list, key, size, lists, company, c) of the members of long lists that may have partners which no short list has."""
    lists = _unpacked(packed, _LONG).join(in_long.withColumnRenamed("member", "key"), "key")
    least = lists.groupBy("list").agg(F.min(F.when(F.col("lists") >= F.col("c"), F.col("c"))).alias("least"))
    return cut_lineage(lists.join(least, "list").where("lists >= least").drop("least"))


def _within(batches):
    """The pairs that the sketch bound does not exclude."""
    for batch in batches:
        x, y = (batch[f"sketch_{c}"].to_pylist() for c in "ab")
        size = batch["size_a"].to_numpy() + batch["size_b"].to_numpy()
        width = np.array([min(len(i), len(j)) for i, j in zip(x, y, strict=True)], np.int64)
        keep = np.zeros(len(width), bool)
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            own, other = (_folded([v[i] for i in at.tolist()], w) for v in (x, y))
            keep[at] = 9 * np.bitwise_count(own ^ other).sum(1, dtype=np.int64) <= size[at]
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep))


def _near_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sketches are near."""
    for c in ("a", "b"):
        pairs = pairs.join(sketches.withColumnsRenamed({"key": c, "size": f"size_{c}", "sketch": f"sketch_{c}"}), c)
    return cut_lineage(pairs.mapInArrow(X.batch_by_batch(_within), "a bigint, b bigint"))


def _near(table: pa.Table) -> pa.Table:
    """Pairs of members of one list, from one or two of its blocks, that are apart and within both bounds."""
    table = table.combine_chunks()
    key, size, component, block, lists, need = (table[c].to_numpy() for c in ("key", "size", "component", "block", "lists", "c"))
    sketch = table["sketch"].to_pylist()
    width = np.array([len(x) for x in sketch], np.int64)
    cells, place = {}, np.zeros(len(key), np.int64)
    for w in np.unique(width).tolist():  # sets in reach of each other have the same width or one twice the other
        cells[w, w], cells[w, 2 * w] = (_folded([sketch[i] for i in np.flatnonzero(width == v).tolist()], w) for v in (w, 2 * w))
        place[width == w] = np.arange(int((width == w).sum()))
    low, high = table["i"][0].as_py(), table["j"][0].as_py()
    own, other = np.flatnonzero(block == low), np.flatnonzero(block == high)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, x in enumerate(own.tolist()):
        y = own[k + 1 :] if low == high else other
        y = y[(component[y] != component[x]) & (5 * np.minimum(size[y], size[x]) >= 4 * np.maximum(size[y], size[x]))]
        y = y[np.minimum(lists[y], lists[x]) >= np.minimum(need[y], need[x])]
        for w in np.unique(width[y]).tolist():
            z, least = y[width[y] == w], min(w, int(width[x]))
            z = z[9 * np.bitwise_count(cells[least, w][place[z]] ^ cells[least, int(width[x])][place[x]]).sum(1, dtype=np.int64) <= size[z] + size[x]]
            a.append(np.minimum(key[z], key[x]))
            b.append(np.maximum(key[z], key[x]))
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def _linked(tries: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link; only the sets that are tried are shuffled."""
    others = sets.join(tries.select("b"), F.col("key") == F.col("b"), "left_semi")
    both = sets.withColumnsRenamed({"key": "a", "shingles": "x"}).join(tries, "a").join(others.withColumnsRenamed({"key": "b", "shingles": "y"}), "b")
    return cut_lineage(both.select("a", "b", "x", "y").mapInArrow(X.batch_by_batch(_probe), "a bigint, b bigint"))


def _groups(pairs: DataFrame, lists: DataFrame, sketches: DataFrame, linked: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of set keys, in two rounds as told above."""
    lists = cut_lineage(lists.join(sketches.select("key", "sketch"), "key"))
    pivot = lists.groupBy("list").agg(F.max(F.struct("company", "key", "size", "sketch")).alias("p"))
    reach = 5 * F.least("size", "p.size") >= 4 * F.greatest("size", "p.size")
    to_pivot = lists.join(pivot, "list").where((F.col("key") != F.col("p.key")) & reach)
    to_pivot = to_pivot.select(F.least("key", "p.key").alias("a"), F.greatest("key", "p.key").alias("b"), F.col("size").alias("size_a"), F.col("p.size").alias("size_b"), F.col("sketch").alias("sketch_a"), F.col("p.sketch").alias("sketch_b"))
    to_pivot = to_pivot.mapInArrow(X.batch_by_batch(_within), "a bigint, b bigint")
    tries = X.written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").union(to_pivot).distinct())
    links = linked(tries)

    groups = cut_lineage(components(links).withColumnRenamed("node", "key"))
    rest = pairs
    for c in ("a", "b"):
        rest = rest.join(groups.select(F.col("key").alias(c), F.col("component").alias(f"component_{c}")), c, "left")
    rest = rest.where("coalesce(component_a, a) != coalesce(component_b, b)").select("a", "b")
    members = lists.drop("company").join(groups, "key", "left").withColumn("component", F.coalesce("component", "key"))
    mixed = members.groupBy("list").agg((F.min("component") != F.max("component")).alias("mixed"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("mixed").drop("mixed")
    blocks = members.join(mixed, "list").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.select("list", "key", "size", "component", "block", "lists", "c", "sketch", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    near = blocks.groupBy("list", "i", "j").applyInArrow(X.whole_group(_near), "a bigint, b bigint")
    rest = X.written(rest.union(near).distinct().join(tries, ["a", "b"], "left_anti"))
    if rest.isEmpty():
        return groups.withColumnRenamed("key", "node")
    return components(links.union(linked(rest)))


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
