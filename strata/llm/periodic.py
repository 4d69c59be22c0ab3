"""Periodic runs of words by longest common extensions in suffix trees.

A run is a maximal stretch of consecutive words with smallest period ``q`` (words ``q`` apart are the
same) that is long enough: ``least`` words and ``times`` periods. A document's words become symbols, and
Ukkonen's algorithm builds the suffix tree of the symbols and that of their reversal. The Euler tour
of a tree, kept at its turning points (where the tour leaves one leaf's branch for the next one's),
gives the depth of the lowest common ancestor of any two leaves as the minimum of a range, from a table
of minima of ranges of 1, 2, 4, ... turning points: constant time for a pair, in numpy for all pairs. By
the theorem of runs, each run holds a Lyndon root that is the longest Lyndon word at its place, in the
order of the symbols or in the reversed order. These words follow from the leaf orders of the tree (the
word at a place ends where the next smaller suffix starts); each is extended to both sides by one
look-up in either tree, and what comes out long enough is a run with its smallest period.

Before that, stretches that no run can hold are cut out: three words in a row within a run occur in it
three times at least, five words twice (``times`` >= 4, ``least`` >= 6). Each cut stretch is one symbol of its own
in the trees. The cut counts by hash, so that a collision only leaves more in; symbols are whole words.

All of it happens document by document inside one Arrow pass: nothing is shuffled, and memory is bounded
by a slice of texts or the longest text (about 1.5 KB for each word of it that is left in).

Cases: NULL, empty and wordless texts have no words and no runs, and an empty collapsed text; rows with
equal ids or texts are documents of their own; ids are carried as they are and are read by nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import extra, named, with_extra
from .text import Roller, Words, byte_values, mix, slices, string_array, text_buffers

LEAST, TIMES = 6, 4
_BASE_WORD, _BASE_GRAM = 0x5851F42D4C957F2D, 0x2545F4914F6CDD1D


def suffix_tree(symbols: list[int]) -> tuple[list[int], list[dict[int, int]], list[int]]:
    """Ukkonen's online construction. The last symbol occurs nowhere else.

    Returns the length of each node's edge label, each node's children by first symbol (None for a leaf), and the
    leaves in the order of their suffixes; node 0 is the root."""
    n = len(symbols)
    start, end, link = [-1], [0], [0]
    children: list[dict[int, int] | None] = [{}]
    leaves = []
    node = at = length = 0  # the active point: a node, and on its edge with symbol symbols[at] so many symbols
    pending = 0
    for i, c in enumerate(symbols):
        pending += 1
        before = 0  # the inner node made last in this phase, which still lacks its suffix link
        while pending:
            if not length:
                at = i
            kids = children[node]
            child = kids.get(symbols[at])
            if child is None:
                kids[symbols[at]] = len(start)
                leaves.append(len(start))
                start.append(i)
                end.append(n)
                link.append(0)
                children.append(None)
                if before:
                    link[before] = node
                    before = 0
            else:
                size = (end[child] if end[child] < i + 1 else i + 1) - start[child]
                if length >= size:
                    node = child
                    at += size
                    length -= size
                    continue
                if symbols[start[child] + length] == c:
                    length += 1
                    if before:
                        link[before] = node
                    break
                split = len(start)
                kids[symbols[at]] = split
                start.append(start[child])
                end.append(start[child] + length)
                link.append(0)
                start[child] += length
                children.append({symbols[start[child]]: child, c: split + 1})
                leaves.append(split + 1)
                start.append(i)
                end.append(n)
                link.append(0)
                children.append(None)
                if before:
                    link[before] = split
                before = split
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - pending + 1
    size = [e - s for s, e in zip(start, end, strict=True)]
    size[0] = 0
    return size, children, leaves


def tour(size: list[int], children: list, order=sorted) -> tuple[list[int], list[int]]:
    """The leaves as the Euler tour meets them, and the tour's turning points: the string depth of the lowest
    common ancestor of each leaf and the one before it (0 for the first)."""
    met, turns = [], []
    stack = [(0, 0)]
    turn = 0
    while stack:
        node, depth = stack.pop()
        if turn is None:
            turn = depth
        kids = children[node]
        if kids is None:
            met.append(node)
            turns.append(turn)
            turn = None
        else:
            depth += size[node]
            for symbol in reversed(order(kids)):
                stack.append((kids[symbol], depth))
    return met, turns


class Extensions:
    """Longest common extensions of any two places, in constant time for a pair after the tree is built."""

    def __init__(self, symbols: list[int]):
        self.tree = suffix_tree(symbols)
        size, children, leaves = self.tree
        self.suffix = np.zeros(len(size), np.int64)
        self.suffix[leaves] = np.arange(len(leaves))
        met, turns = tour(size, children)
        self.rank = np.empty(len(met), np.int64)
        self.rank[self.suffix[met]] = np.arange(len(met))
        self.least = [np.array(turns, np.int32)]
        for step in 2 ** np.arange(max(0, len(met) - 1).bit_length()):
            if 2 * step > len(met):
                break
            self.least.append(np.minimum(self.least[-1][:-step], self.least[-1][step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of different places, how many symbols from there on agree."""
        x, y = np.minimum(self.rank[a], self.rank[b]) + 1, np.maximum(self.rank[a], self.rank[b]) + 1
        level = np.frexp((y - x).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.least[k][x[m]], self.least[k][y[m] - (1 << k)])
        return out

    def rank_in_reversed_order(self, unique_below: int) -> np.ndarray:
        """Ranks of the suffixes if the symbols' order is turned round, but for those below ``unique_below``."""
        size, children, _ = self.tree

        def order(kids):
            words = sorted((s for s in kids if s >= unique_below), reverse=True)
            return [*sorted(s for s in kids if s < unique_below), *words]

        met, _ = tour(size, children, order)
        rank = np.empty(len(met), np.int64)
        rank[self.suffix[met]] = np.arange(len(met))
        return rank


def lyndon_ends(rank: list[int]) -> list[int]:
    """For each place but the last, where the longest Lyndon word that starts there ends: at the next smaller suffix."""
    out = [0] * len(rank)
    stack: list[int] = []
    for i in range(len(rank) - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] if stack else len(rank)
        stack.append(i)
    return out


def runs_of(pieces: list[list], starts: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a document, by start, then period; ``pieces`` are stretches of its words
    and ``starts`` their places. Each stretch ends with a symbol of its own, smaller than all words in both orders."""
    number: dict = {}
    first = len(pieces) + 1
    symbols: list[int] = []
    place: list[int] = []
    for k, (words, at) in enumerate(zip(pieces, starts, strict=True)):
        symbols += [number.setdefault(w, first + len(number)) for w in words]
        symbols.append(k + 1)
        place += range(at, at + len(words) + 1)
    n = len(symbols)
    forward = Extensions([*symbols, 0])
    backward = Extensions([*reversed(symbols), 0])
    inside = np.array(symbols) >= first
    found = []
    for rank in (forward.rank, forward.rank_in_reversed_order(first)):
        root = np.flatnonzero(inside)
        period = np.array(lyndon_ends(rank.tolist()), np.int64)[root] - root
        right = forward(root, root + period)
        left = backward(n - root, n - root - period)
        length = period + left + right
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([np.array(place, np.int64)[root - left][long], period[long], length[long]], axis=1))
    return [(s, m, q) for s, q, m in np.unique(np.concatenate(found), axis=0).tolist()]


def _stretches(w: Words, hashes: np.ndarray, roller: Roller) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of words, each within a document, outside which no run of LEAST words and TIMES periods has a word."""
    lo, hi = w.of_doc[:-1], w.of_doc[1:]
    prefix = roller.prefix(hashes)
    for width, often in ((3, 3), (5, 2), (3, 3), (5, 2), (3, 3)):
        long = hi - lo >= LEAST
        lo, hi = lo[long], hi[long]
        if not len(lo):
            break
        n = hi - lo - width + 1
        piece = np.repeat(np.arange(len(lo)), n)
        at = np.arange(len(piece)) + np.repeat(lo - (np.cumsum(n) - n), n)
        key = mix(roller.ranges(prefix, at, at + width) + mix(piece.astype(np.uint64), 6), 7)
        _, group, count = np.unique(key, return_inverse=True, return_counts=True)
        good = count[group] >= often
        at, piece = at[good], piece[good]
        if not len(at):
            return lo[:0], hi[:0]
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(piece) != 0)) + 1
        lo, hi = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])] + width
    long = hi - lo >= LEAST
    return lo[long], hi[long]


def _find(batches):
    byte, gram, values = Roller(_BASE_WORD), Roller(_BASE_GRAM), byte_values()
    for batch in batches:
        data, offsets = text_buffers(batch["text"])
        for a, b in slices(offsets):
            w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            lo, hi = _stretches(w, w.hashes(byte, values), gram)
            doc = np.searchsorted(w.of_doc, lo, "right") - 1
            raw, begin, end = w.data.tobytes(), w.start.tolist(), w.end.tolist()
            per_doc: list[list] = [[] for _ in range(b - a)]
            cut = np.flatnonzero(np.diff(doc)) + 1
            for own in np.split(np.arange(len(doc)), cut) if len(doc) else []:
                d, first = int(doc[own[0]]), int(w.of_doc[doc[own[0]]])
                ranges = list(zip(lo[own].tolist(), hi[own].tolist(), strict=True))
                pieces = [[raw[x:y] for x, y in zip(begin[s:e], end[s:e], strict=True)] for s, e in ranges]
                per_doc[d] = runs_of(pieces, [s - first for s, _ in ranges])
            edge = np.zeros(len(w) + 1, np.int64)
            flat = np.array([(int(w.of_doc[d]) + s + q, int(w.of_doc[d]) + s + m) for d, runs in enumerate(per_doc) for s, m, q in runs], np.int64).reshape(-1, 2)
            np.add.at(edge, flat[:, 0], 1)
            np.add.at(edge, flat[:, 1], -1)
            collapsed = string_array(*w.joined(np.cumsum(edge[:-1]) == 0))
            sizes = np.cumsum([0, *map(len, per_doc)])
            cols = np.array([r for runs in per_doc for r in runs], np.int64).reshape(-1, 3)
            runs = pa.StructArray.from_arrays([pa.array(cols[:, k]) for k in range(3)], ["start", "length", "period"])
            part = batch.slice(a, b - a)
            names = ["id", "n_words", "runs", "collapsed"] + (["extra"] if "extra" in part.schema.names else [])
            arrays = [part["id"], pa.array(w.counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), runs), collapsed]
            yield pa.RecordBatch.from_arrays([*arrays, *([part["extra"]] if "extra" in names else [])], names)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row for each document: (id, n_words, runs, collapsed), and with ``carry`` a struct ``extra`` of those
    columns. ``runs`` are (start, length, period) in words, by start, then period; ``collapsed`` is the words that
    no run holds after its first period, joined by one space."""
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"), *([extra(carry)] if carry is not None else []))
    fields = with_extra(kept, "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    return kept.mapInArrow(_find, StructType([kept.schema["id"], *fields]))


def _repeat_tails(batches):
    for batch in batches:
        ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
        for k, i in enumerate(ids):
            h = zlib.crc32(str(i).encode()) if i is not None else 1
            if h % 10 == 0:
                texts[k] = tail_repeated(texts[k] or "", h // 10)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])


def tail_repeated(text: str, g: int) -> str:
    """The text's words, where those from a place that g names on repeat a period that g names."""
    data, offsets = text_buffers(pa.array([text], pa.string()))
    w = Words(data, offsets)
    n = len(w)
    if not n:
        return text
    raw = data.tobytes()
    words = [raw[x:y] for x, y in zip(w.start.tolist(), w.end.tolist(), strict=True)]
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    words[a:] = [words[a + k % p] for k in range(n - a)]
    return b" ".join(words).decode()


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, chosen by crc32 of the id, get a periodic tail; a NULL id does not."""
    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(_repeat_tails, kept.schema)


def digests(found: DataFrame) -> DataFrame:
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = found.withColumn("best", longest)
    return best.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listing, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_periodic_run_detection(spark, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(with_repeated_tails(spark.read.parquet(f"{sf_dir}/documents.parquet"))))
