"""Benchmark decontamination: CGK embedding and bit-sampling LSH over item-sized windows.

Words (letters and digits, A-Z lower-cased) are the symbols. A document is contaminated by an item
of n words if a stretch of it is within ``k = floor(n * MOST_EDITS)`` word edits of the item.

1. *Windows*: any such stretch holds at least ``n - 1 - 2k`` of the item's word pairs within n + k
   words (an edit breaks two pairs at most; a pair counts as often as the item has it), so only
   item-sized windows where that many of the item's pairs fall together are looked at. The bound
   is exact: it loses no match.
2. *Embedding*: the CGK random walk reads a window (or item) word by word: step j writes the current
   word, and a random bit of (j, word) decides whether to go on to the next. It maps edit distance to
   Hamming distance: one edit shifts the walks against each other, until they meet again.
3. *LSH*: each repetition has a walk of its own and compares some sampled places. A window is a candidate if all places
   of one repetition agree. Repetitions and places follow from the item's length (``REPETITIONS``): so many that copies
   with as many edits as are allowed are candidates with a chance of 0.95 or more, which a test measures.
4. *Verification*: candidates are widened by k words and the exact smallest number of word edits between the item and
   any stretch in them is computed, repetition by repetition, until one proves near (``by_lsh``). What no
   repetition finds is the exact remainder: the windows of step 1 that were no candidates are verified as well, so that
   no match is lost, at any length; the share of ``by_lsh`` among the matches is the recall of the LSH alone.

Items are broadcast in parts of at most ``PART_BYTES`` of text (one here), each part being one pass
over the documents; documents are never shuffled. The result is one row for each document and item.

Cases: NULL and empty texts hold no item; items of one word are in no pair and match that word wherever
it is, items of none match nothing; items with equal texts each match; rows with equal ids are documents of their own; an item of a few
words (n < 5) matches only as it is. One document's repeated passages give the best one's place.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .exchange import batch_by_batch, named
from .text import Roller, Words, byte_values, letter_bytes, lower_table, mix, slices, text_buffers

#: Word edits for each word of an item.
MOST_EDITS = 0.2
#: Up to so many words an item has (repetitions, places that one compares).
REPETITIONS = {12: (12, 3), 60: (18, 2), math.inf: (14, 1)}
PART_BYTES = 8 << 20

_BASE_WORD = 0x5851F42D4C957F2D
_END = np.uint64(0)


def edits_allowed(n: int, most_edits: float = MOST_EDITS) -> int:
    return math.floor(n * most_edits + 1e-9)


def walk(words: np.ndarray, lengths: np.ndarray, steps: np.ndarray, table: int) -> np.ndarray:
    """What CGK walks over the rows of ``words`` write at some steps. Past a row's end they write an
    end mark. Only the steps up to the last one asked for are made."""
    at = np.zeros(len(words), np.int64)
    rows = np.arange(len(words))
    out = np.empty((len(words), len(steps)), np.uint64)
    wanted = {int(s): i for i, s in enumerate(steps)}
    for j in range(int(steps.max()) + 1):
        now = np.where(at < lengths, words[rows, np.minimum(at, words.shape[1] - 1)], _END)
        if j in wanted:
            out[:, wanted[j]] = now
        at += (mix(now ^ np.uint64(j), 40 + table) & np.uint64(1)).astype(np.int64)
    return out


def repetitions(n: int) -> tuple[int, int]:
    """(repetitions, places) for items of n words."""
    return next(v for most, v in REPETITIONS.items() if n <= most)


def sampled_steps(n: int, table: int) -> np.ndarray:
    """The steps that a repetition compares, for items of n words: of the first 2n - 1 (a walk is done after about 2n)."""
    r, bits = np.random.default_rng([table, n]), repetitions(n)[1]
    return np.sort(r.choice(max(1, 2 * n - 1), min(bits, max(1, 2 * n - 1)), replace=False))


def agrees(windows: np.ndarray, lengths: np.ndarray, item: np.ndarray, table: int) -> np.ndarray:
    """Which windows a repetition takes for the item."""
    steps = sampled_steps(len(item), table)
    return (walk(windows, lengths, steps, table) == walk(item[None, :], np.array([len(item)]), steps, table)).all(1)


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of the text with the fewest word edits to the item; the first such end."""
    # one row for each word of the item; a column for each end in the text; starts travel along
    cost, start = np.zeros(len(text) + 1, np.int64), np.arange(len(text) + 1)
    span = np.arange(len(text) + 1)
    for i, w in enumerate(item):
        down, over = cost + 1, cost[:-1] + (text != w)
        new, origin = np.empty_like(cost), np.empty_like(start)
        new[0], origin[0] = i + 1, 0
        diagonal = over <= down[1:]
        new[1:] = np.where(diagonal, over, down[1:])
        origin[1:] = np.where(diagonal, start[:-1], start[1:])
        # words of the text that the item lacks: the smallest new[j] + (end - j)
        low = new - span
        run = np.minimum.accumulate(low)
        from_ = np.maximum.accumulate(np.where(low == run, span, 0))
        cost, start = run + span, origin[from_]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Items:
    """Word hashes of items, and an index of their word pairs."""

    def __init__(self, ids: list, texts: list[str], most_edits: float = MOST_EDITS):
        roller = Roller(_BASE_WORD)
        data, offsets = text_buffers(pa.array(texts, pa.string()))
        w = Words(data, offsets, letter_bytes()[data])
        h = w.hashes(roller, byte_values(), lower_table())
        every = [h[a:b] for a, b in zip(w.of_doc[:-1], w.of_doc[1:], strict=True)]
        own = [i for i, x in enumerate(every) if len(x)]
        self.ids, self.words = [ids[i] for i in own], [every[i] for i in own]
        self.edits = np.array([edits_allowed(len(x), most_edits) for x in self.words], np.int64)
        self.need = np.array([max(1, len(x) - 1 - 2 * k) for x, k in zip(self.words, self.edits, strict=True)], np.int64)
        single = [i for i, x in enumerate(self.words) if len(x) == 1]
        word = np.array([self.words[i][0] for i in single], np.uint64)
        order = np.argsort(word, kind="stable")
        #: Words that are items, and for each the items that it is.
        self.single, first = np.unique(word[order], return_index=True)
        self.single_of, self.single_cut = np.array(single, np.int64)[order], np.append(first, len(word))
        pairs = [np.unique(pair_hashes(x), return_counts=True) for x in self.words]
        keys = np.concatenate([np.zeros(0, np.uint64), *(p for p, _ in pairs)])
        times = np.concatenate([np.zeros(0, np.int64), *(m for _, m in pairs)])
        of = np.repeat(np.arange(len(pairs)), [len(p) for p, _ in pairs])
        order = np.argsort(keys, kind="stable")
        self.pair, first = np.unique(keys[order], return_index=True)
        #: For each pair the items that have it, and how often.
        self.of, self.times, self.cut = of[order], times[order], np.append(first, len(keys))
        self.leads = np.zeros(1 << 20, bool)
        self.leads[(self.pair >> np.uint64(44)).astype(np.int64)] = True


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] + mix(h[1:], 41), 42)


def _single(items: Items, h: np.ndarray, w: Words):
    """The same rows as ``_find``, for items of one word: where a document has it first."""
    if not len(items.single) or not len(h):
        return
    row = np.minimum(np.searchsorted(items.single, h), len(items.single) - 1)
    place = np.flatnonzero(items.single[row] == h)
    doc = np.searchsorted(w.of_doc, place, "right") - 1
    _, first = np.unique(doc * len(items.single) + row[place], return_index=True)
    for x in first.tolist():
        d, p, r = int(doc[x]), int(place[x]), int(row[place[x]])
        for i in items.single_of[items.single_cut[r] : items.single_cut[r + 1]].tolist():
            yield d, i, 0, p - int(w.of_doc[d]), 1, True


def _find(items: Items, h: np.ndarray, w: Words):
    """(document, item, edits, first word, words, by LSH) for each document and item of a slice."""
    yield from _single(items, h, w)
    at = w.gram_starts(1)
    pair = mix(h[at] + mix(h[at + 1], 41), 42)
    some = np.flatnonzero(items.leads[pair >> np.uint64(44)])
    if not len(some) or not len(items.pair):
        return
    row = np.minimum(np.searchsorted(items.pair, pair[some]), len(items.pair) - 1)
    hit = items.pair[row] == pair[some]
    place, row = at[some[hit]], row[hit]
    count = items.cut[row + 1] - items.cut[row]
    place, kind = np.repeat(place, count), np.repeat(row, count)
    at = np.repeat(items.cut[row] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    of, times = items.of[at], items.times[at]
    doc = np.searchsorted(w.of_doc, place, "right") - 1
    group = doc * len(items.ids) + of
    # documents with enough of an item's pairs, wherever they are
    order = np.lexsort((kind, group))
    g, k_ = group[order], kind[order]
    begin = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (k_[1:] != k_[:-1])])) if len(g) else np.zeros(0, np.int64)
    seen = np.minimum(np.diff(np.append(begin, len(g))), times[order][begin])
    which, at = np.unique(g[begin], return_inverse=True)
    which = which[np.bincount(at, seen, len(which)) >= items.need[which % len(items.ids)]]
    own = np.isin(group, which)
    place, kind, group, times = place[own], kind[own], group[own], times[own]
    order = np.lexsort((place, group))
    place, kind, group, times = place[order], kind[order], group[order], times[order]
    cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else np.zeros(1, np.int64)
    for g in range(len(cut) - 1):
        hits, kinds, most = (x[cut[g] : cut[g + 1]] for x in (place, kind, times))
        d, i = divmod(int(group[cut[g]]), len(items.ids))
        item, k, need = items.words[i], int(items.edits[i]), int(items.need[i])
        n = len(item)
        # places where enough of the item's pairs fall within n + k words
        stop = np.searchsorted(hits, hits + n + k - 2, "right")
        close = np.flatnonzero(stop - np.arange(len(hits)) >= need)
        close = np.array([x for x in close.tolist() if _together(kinds[x : stop[x]], most[x : stop[x]]) >= need], np.int64)
        if not len(close):
            continue
        low, high = int(w.of_doc[d]), int(w.of_doc[d + 1])
        # item-sized windows that hold them, each once
        a = np.maximum(hits[close + need - 1] + 2 - n - k, low)
        starts = np.unique(np.concatenate([np.arange(x, y + 1) for x, y in zip(a.tolist(), hits[close].tolist(), strict=True)]))
        best = None
        # each region of neighbouring windows until one of its windows is verified
        for region in np.split(starts, np.flatnonzero((np.diff(starts) > 1) | (np.arange(1, len(starts)) % (4 * n) == 0)) + 1):
            found = _verified(h, region, low, high, item, k)
            if found and (best is None or found[0] < best[0]):
                best = found
        if best:
            yield d, i, best[0], best[1] - low, best[2], best[3]


def _together(kinds: np.ndarray, most: np.ndarray) -> int:
    """Pairs in a window, each kind as often as the item has it at most."""
    _, first, n = np.unique(kinds, return_index=True, return_counts=True)
    return int(np.minimum(n, most[first]).sum())


def _verified(h: np.ndarray, starts: np.ndarray, low: int, high: int, item: np.ndarray, k: int):
    """(edits, start, words, whether by the LSH) of the best stretch about the windows of a region, if a stretch about
    the candidates of a repetition, or else about the windows that are left, is near."""
    n = len(item)
    size = np.minimum(n, high - starts)
    windows = h[np.minimum(starts[:, None] + np.arange(n), len(h) - 1)]
    tried = np.zeros(len(starts), bool)

    def about(own: np.ndarray) -> tuple[int, int]:
        return max(low, int(starts[own[0]]) - k), min(high, int(starts[own[-1]]) + n + k)

    for t in range(repetitions(n)[0] + 1):
        rest = t == repetitions(n)[0]
        new = np.flatnonzero(~tried if rest else agrees(windows, size, item, t) & ~tried)
        tried[new] = True
        if len(new) and best_stretch(item, h[slice(*about(new))])[0] <= k:
            left, right = about(np.array([0, len(starts) - 1]))
            edits, x, y = best_stretch(item, h[left:right])
            return edits, left + x, y - x, not rest
        if tried.all():
            break
    return None


def _search(items, id_type: pa.DataType):
    def search(batches):
        known = Items(*items.value)
        roller, values, letters, fold = Roller(_BASE_WORD), byte_values(), letter_bytes(), lower_table()
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                own = data[offsets[a] : offsets[b]]
                w = Words(own, offsets[a : b + 1] - offsets[a], letters[own])
                rows = list(_find(known, w.hashes(roller, values, fold), w))
                d, i, edits, first, n, by_lsh = (list(x) for x in zip(*rows, strict=True)) if rows else ([],) * 6
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a).take(pa.array(d, pa.int64())), pa.array([known.ids[x] for x in i], id_type), *(pa.array(x, pa.int32()) for x in (first, n, edits)), pa.array([1 - e / len(known.words[x]) for e, x in zip(edits, i, strict=True)], pa.float64()), pa.array(by_lsh, pa.bool_())], ["id", "item_id", "first_word", "n_words", "edits", "similarity", "by_lsh"])

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """(id, item_id, first_word, n_words, edits, similarity, by_lsh) for each document and item it holds."""
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    wanted = benchmark.select(named(item_col).alias("item_id"), F.coalesce(named(item_text), F.lit("")).alias("text"))
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(total / part_bytes))
    schema = StructType([kept.schema["id"], wanted.schema["item_id"], *StructType.fromDDL("first_word int, n_words int, edits int, similarity double, by_lsh boolean")])
    out = None
    for p in range(parts):  # each part is bounded, however many there are
        rows = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).toArrow()
        items = docs.sparkSession.sparkContext.broadcast((rows["item_id"].to_pylist(), rows["text"].to_pylist()))
        found = kept.mapInArrow(batch_by_batch(_search(items, rows.schema.field("item_id").type)), schema)
        out = found if out is None else out.union(found)
    return out


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    out = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.withColumnRenamed("id", "doc_id")
