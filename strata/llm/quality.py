"""Quality classifier: Bradley-Terry pairwise ranking over features of the whole text.

Each training pair is a document labelled 1 preferred to one labelled 0; the probability that a is
preferred to b is ``sigmoid(w . (f(a) - f(b)))``, and w minimises the logistic loss over all pairs'
feature differences (Newton steps, small L2 term). A document's worth is ``w . f``. The cut is the
quantile of the training documents' worth at the share of documents labelled 0; a score is the
logistic of the worth, moved so that the cut has score ``AT_CUT``.

Features are computed in one vectorised pass (whole texts). The model is fitted on all labelled documents:
their features, some 20 numbers each, are dealt by a hash of the id into groups of some ``GROUP``, and pairs are
made within a group. Each step of the fit is a pass over the groups, which give their sums. Documents of a
class too small to be in every group stand in all groups.

Cases: NULL and empty texts have all features 0 and get their score like others; without labelled
rows, or with one class only, every score is the same (1 if all are labelled 1, 0 if all 0, else 0.5).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import labels as L
from .exchange import named
from .text import Roller, Words, byte_values, slices, text_buffers

#: Labelled documents of a group, on average; pairs that each document labelled 0 stands in.
GROUP, PAIRS = 20_000, 8
#: Documents of a class for each group, below which the class stands in all groups.
FEW = 32
#: Steps in which an interval that holds the cut is narrowed, parts it is cut into, and values of it that are read at last.
_NARROW, _PARTS, _READ = 10, 1024, 20_000
#: The score of a document at the cut.
AT_CUT = 0.3
_RIDGE, _STEPS = 1e-3, 30
_BASE_WORD = 0x5851F42D4C957F2D

_MARKS = ("|", "!", "*", "&", "%", "#", "$", ".,;:?", "<>{}[]=/\\_^~@+")
FEATURES = ["log_bytes", "word_bytes", "words_again", "distinct_words", "distinct_lines", "line_words", "upper", "digits", "upper_words", "marked_words", *[f"marks_{i}" for i in range(len(_MARKS))]]


class Features:
    """One row of numbers for each document of a slice."""

    def __init__(self):
        self.roller, self.values = Roller(_BASE_WORD), byte_values()
        kind = np.zeros(256, np.int64)
        kind[ord("A") : ord("Z") + 1], kind[ord("a") : ord("z") + 1], kind[ord("0") : ord("9") + 1] = 1, 2, 3
        for i, marks in enumerate(_MARKS):
            kind[[ord(c) for c in marks]] = 4 + i
        self.kind = kind

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        size = np.diff(offsets).astype(float)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        kinds = 4 + len(_MARKS)
        counts = np.bincount(doc * kinds + self.kind[data], minlength=n * kinds).reshape(n, kinds).astype(float)
        w = Words(data, offsets)
        words = np.maximum(w.counts, 1)
        h = w.hashes(self.roller, self.values)
        of = w.doc_of()
        per = lambda x, k=of: np.bincount(k, x, n)
        again = np.zeros(len(h))
        again[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
        last = data[w.end - 1] if len(w) else np.zeros(0, np.uint8)
        upper = np.concatenate([[0], np.cumsum(self.kind[data] == 1)])
        lower = np.concatenate([[0], np.cumsum(self.kind[data] == 2)])
        shout = (upper[w.end] - upper[w.start] > 1) & (lower[w.end] == lower[w.start])
        lines = Words(data, offsets, data != 0x0A)
        line_hash = lines.hashes(self.roller, self.values)
        letters = np.maximum(counts[:, 1] + counts[:, 2], 1)
        some = np.maximum(size, 1)[:, None]
        return np.column_stack([
            np.log1p(size),
            per((w.end - w.start).astype(float)) / words,
            per(again) / words,
            _distinct(h, w.of_doc) / words * np.log1p(words),
            _distinct(line_hash, lines.of_doc) / np.maximum(lines.counts, 1),
            np.log1p(w.counts / np.maximum(lines.counts, 1)),
            counts[:, 1] / letters,
            counts[:, 3] / some[:, 0],
            per(shout.astype(float)) / words,
            per((self.kind[last] >= 4).astype(float)) / words,
            np.sqrt(counts[:, 4:] / some),
        ])


def _distinct(hashes: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return np.array([len(np.unique(hashes[a:b])) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], float)


def _features(carry: list[str]):
    def features(batches):
        of = Features()
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                x = of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                rows = pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(a, b - a) for c in carry), rows], [*carry, "features"])

    return features


class Group:
    """Features and labels of a group in the order of (turn, id), with which of them are its own: others are counted elsewhere."""

    def __init__(self, turn, ids, label, features, own):
        order = np.lexsort((ids, turn))
        self.x, self.y, self.own = features[order], label[order] > 0, own[order]

    def moments(self) -> list[float]:
        x, y = self.x[self.own], self.y[self.own]
        mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
        return [float(len(x)), float(y.sum()), *mean, *((x - mean) ** 2).sum(0)]

    def pairs(self, mean, spread) -> np.ndarray:
        x = (self.x - mean) / spread
        good, bad = np.flatnonzero(self.y), np.flatnonzero(~self.y)
        if not len(good) or not len(bad):
            return np.zeros((0, x.shape[1]))
        # every document is in a pair: the smaller class goes round until the larger is used up, at least PAIRS times
        n = max(PAIRS * len(bad), len(good), len(bad))
        return x[good[np.arange(n) % len(good)]] - x[bad[(np.arange(n) + np.arange(n) // max(len(good), len(bad))) % len(bad)]]

    def slope(self, mean, spread, w) -> list[float]:
        """Number of pairs, then the loss's slope and curvature summed over them."""
        d = self.pairs(mean, spread)
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        return [float(len(d)), *(d.T @ (1 - p)), *((d * (p * (1 - p))[:, None]).T @ d).ravel()]

    def worth(self, mean, spread, w) -> np.ndarray:
        return ((self.x - mean) / spread)[self.own] @ w

    def ends(self, mean, spread, w) -> list[float]:
        v = self.worth(mean, spread, w)
        return [float(v.min()), float(v.max())] if len(v) else [np.inf, -np.inf]

    def counts(self, mean, spread, w, edges) -> list[float]:
        """How many are worth at most each of the edges."""
        return np.searchsorted(np.sort(self.worth(mean, spread, w)), edges, side="right").astype(float).tolist()

    def values(self, mean, spread, w, lo, hi) -> list[float]:
        """Value and number in turn of those worth over ``lo`` and at most ``hi``."""
        v = self.worth(mean, spread, w)
        return np.column_stack(np.unique(v[(v > lo) & (v <= hi)], return_counts=True)).astype(float).ravel().tolist()


def _kth(over, args, k: int, lo: float, hi: float) -> float:
    """The value with ``k`` values before it in their order; all lie over ``lo`` and at most at ``hi``."""
    below, inside = 0, None
    for _ in range(_NARROW):
        edges = np.unique(np.linspace(lo, hi, _PARTS + 1))
        n = np.sum(over("counts", *args, edges), axis=0)
        at = int(np.searchsorted(n, k, side="right"))
        lo, hi, below, inside = edges[at - 1], edges[at], n[at - 1], n[at] - n[at - 1]
        if inside <= _READ or np.nextafter(lo, hi) >= hi:
            break
    seen = [np.array(v).reshape(-1, 2) for v in over("values", *args, lo, hi)]
    value, number = np.concatenate(seen).T
    order = np.argsort(value, kind="stable")
    return float(value[order][np.searchsorted(np.cumsum(number[order]), k - below, side="right")])


def _solve(over) -> tuple[list[float], float]:
    """(weights, offset): the score of features f is sigmoid(weights . f + offset). ``over(name, *args)`` gives what
    this function of ``Group`` returns for each group."""
    parts = np.array(over("moments"))
    k = (parts.shape[1] - 2) // 2
    each, means = parts[:, :1], parts[:, 2 : 2 + k]
    rows, ones = int(each.sum()), int(parts[:, 1].sum())
    mean = (each * means).sum(0) / rows
    spread = np.sqrt((parts[:, 2 + k :] + each * (means - mean) ** 2).sum(0) / rows)
    spread[spread < 1e-9] = 1
    if ones in (0, rows):
        return [0.0] * k, 30.0 if ones else -30.0
    w = np.zeros(k)
    for _ in range(_STEPS):
        total = np.sum(over("slope", mean, spread, w), axis=0)
        n, slope, bend = total[0], total[1 : 1 + k], total[1 + k :].reshape(k, k)
        step = np.linalg.solve(bend / n + _RIDGE * np.eye(k), slope / n - _RIDGE * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    # the quantile at the share of documents labelled 0
    bad, args = rows - ones, (mean, spread, w)
    ends = np.array(over("ends", *args))
    lo, hi = np.nextafter(ends[:, 0].min(), -np.inf), ends[:, 1].max()
    cut = (_kth(over, args, bad - 1, lo, hi) + _kth(over, args, bad, lo, hi)) / 2
    return (w / spread).tolist(), float(np.log(AT_CUT / (1 - AT_CUT)) - cut - (w / spread) @ mean)


def _arrays(table: pa.Table):
    column = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
    x = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    return column("turn"), column("id"), column("label"), x.reshape(len(table), -1)


def _fit(table: pa.Table) -> pa.Table:
    """The model of one group."""
    group = Group(*_arrays(table), np.ones(len(table), bool))
    weights, offset = _solve(lambda name, *args: [getattr(group, name)(*args)])
    return pa.table({"weights": pa.array([weights]), "offset": pa.array([offset])})


def _pack(table: pa.Table) -> pa.Table:
    turn, ids, label, x = _arrays(table)
    parts = (turn, ids, label.astype(np.int64), np.ascontiguousarray(x), table["own"].combine_chunks().to_numpy(zero_copy_only=False))
    return pa.table({"part": table["part"][:1], **{n: pa.array([p.tobytes()], pa.binary()) for n, p in zip(_PACKED, parts)}})


_PACKED = ("turn", "id", "label", "features", "own")


def _over(packed: DataFrame):
    def over(name: str, *args):
        def apply(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    n = len(r["own"])
                    group = Group(*(np.frombuffer(r[c], np.int64) for c in _PACKED[:3]), np.frombuffer(r["features"]).reshape(n, -1), np.frombuffer(r["own"], bool))
                    yield pa.RecordBatch.from_pydict({"part": pa.array([r["part"]], pa.int32()), "got": pa.array([[float(x) for x in getattr(group, name)(*args)]], pa.list_(pa.float64()))})

        return [r["got"] for r in sorted(packed.mapInArrow(apply, "part int, got array<double>").collect(), key=lambda r: r["part"])]

    return over


def fit_model(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 0, group: int = GROUP) -> tuple[list[float], float]:
    """(weights, offset) of the features."""
    rows = L.training_rows(docs, labels, label, None, id_col, text_col, folds, held_out)
    rows = rows.select(F.xxhash64("id").alias("turn"), F.col("id").cast("long").alias("id"), F.expr("label > 0").cast("int").alias("label"), "text")
    seen = rows.mapInArrow(_features(["turn", "id", "label"]), "turn bigint, id bigint, label int, features array<double>")
    seen = cut_lineage(seen)
    sizes = {r["label"]: r["count"] for r in seen.groupBy("label").count().collect()}
    if not sizes:
        return [0.0] * len(FEATURES), 0.0
    groups = max(1, -(-sum(sizes.values()) // group))
    few = [k for k, n in sizes.items() if n < FEW * groups]
    home = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
    every = F.sequence(F.lit(0), F.lit(groups - 1))
    dealt = seen.withColumn("home", home).withColumn("part", F.explode(F.when(F.col("label").isin(few), every).otherwise(F.array("home"))) if few else F.col("home"))
    dealt = dealt.select("part", "turn", "id", "label", "features", (F.col("part") == F.col("home")).alias("own"))
    return _solve(_over(cut_lineage(dealt.groupBy("part").applyInArrow(_pack, "part int, turn binary, id binary, label binary, features binary, own binary"))))


def _score(weights: list[float], offset: float):
    def score(batches):
        of, w = Features(), np.array(weights)
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                x = of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a), pa.array(1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30))))], ["id", "score"])

    return score


def score_documents(docs: DataFrame, model: tuple[list[float], float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each document."""
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    return kept.mapInArrow(_score(*model), L.schema_of(kept, "score double"))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_documents(docs, fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(F.col("id").alias("doc_id"), L.is_fold(F.col("id"), 5, 0).alias("held_out"), "score", (F.col("score") >= AT_CUT).cast("int").alias("predicted"))
