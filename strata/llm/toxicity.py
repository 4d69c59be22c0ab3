"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct 64-bit hashes of its words, word pairs and skip pairs (a word
and the next but one), letters A-Z lower-cased, punctuation apart. Training reads at most
``SAMPLE`` labelled documents, whole texts: FTRL-proximal takes one document after the other
(per-coordinate rates from the squared gradients so far, L1 and L2 terms, the class rate as a fixed
offset), so this bounded sample is fitted in one task. L1 leaves few of the millions of features; if more than
``MOST_WEIGHTS`` are left, the sample is fitted anew with twice the L1 term, which bounds what is broadcast. The intercept is then put where most
of the fitted documents are told apart. Scoring is one pass over all texts without a shuffle:
hashes that miss a 1 MB table of the weights' leading bits are passed over, the others looked up.

Cases: NULL and empty texts have the intercept only; without labelled rows there are no weights,
every score is 0 and nothing is predicted; labels of one class only give a constant score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labels as L
from .exchange import batch_by_batch, extra, named, whole_group
from .text import Roller, Words, byte_values, letter_bytes, lower_table, mix, slices, text_buffers

#: Labelled documents that a model is fitted on at most, in one task.
SAMPLE = 12_000
#: Passes over them; rate, its offset, and the weights of the L1 and L2 terms; documents that a feature needs.
EPOCHS, ALPHA, BETA, L1, L2, LEAST = 5, 3.0, 1.0, 3.0, 0.0, 3
#: Weights that are broadcast at most (12 bytes each).
MOST_WEIGHTS = 1 << 20

_BASE_WORD = 0x5851F42D4C957F2D
_INTERCEPT = np.uint64(1)


class Features:
    """Feature hashes of the documents of a slice, document by document."""

    def __init__(self, roller: Roller):
        self.roller, self.values, self.letters, self.fold = roller, byte_values(), letter_bytes(), lower_table()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, documents) of all words, word pairs and skip pairs, with repeats."""
        w = Words(data, offsets, self.letters[data])
        h = w.hashes(self.roller, self.values, self.fold)
        doc = w.doc_of()
        out, of = [mix(h, 20)], [doc]
        for reach, seed in ((1, 21), (2, 22)):
            at = w.gram_starts(reach)
            out.append(mix(h[at] + mix(h[at + reach], seed), seed))
            of.append(doc[at])
        return np.concatenate(out), np.concatenate(of)


def _weights(sets: list[np.ndarray], y: np.ndarray, n_features: int, prior: float, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """FTRL-proximal: one document after the other, a rate for each coordinate."""
    z, n, w = np.zeros(n_features), np.zeros(n_features), np.zeros(n_features)
    for _ in range(epochs):
        for x, label in zip(sets, y, strict=True):
            g = 1 / (1 + np.exp(-np.clip(prior + w[x].sum(), -30, 30))) - label
            root = np.sqrt(n[x])
            n[x] += g * g
            grown = np.sqrt(n[x])
            z[x] += g - (grown - root) / alpha * w[x]
            zx = z[x]
            w[x] = np.where(np.abs(zx) <= l1, 0, -(zx - np.sign(zx) * l1) / ((beta + grown) / alpha + l2))
    return w


def _fit(epochs: int, alpha: float, beta: float, l1: float, l2: float, least: int, most: int):
    def fit(table: pa.Table) -> pa.Table:
        """FTRL-proximal over the documents in the order of their ids' hashes."""
        table = table.sort_by([("turn", "ascending"), ("id", "ascending")])
        y = np.asarray(table["label"].combine_chunks()).astype(float)
        data, offsets = text_buffers(table["text"])
        features, sets = Features(Roller(_BASE_WORD)), []
        for a, b in slices(offsets):
            h, d = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            order = np.argsort(d, kind="stable")
            cut = np.searchsorted(d[order], np.arange(b - a + 1))
            sets += [np.unique(h[order[i:j]]) for i, j in zip(cut[:-1], cut[1:], strict=True)]
        every = np.concatenate([np.zeros(0, np.uint64), *sets])
        every.sort()
        new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
        names = every[new[np.diff(np.append(new, len(every))) >= least]]
        del every, new
        for k, own in enumerate(sets):
            at = np.minimum(np.searchsorted(names, own), max(len(names) - 1, 0))
            sets[k] = at[names[at] == own].astype(np.int32) if len(names) else np.zeros(0, np.int32)
        rate = (y.sum() + 0.5) / (len(y) + 1)
        prior = np.log(rate / (1 - rate))
        sparsity = l1
        while np.count_nonzero(w := _weights(sets, y, len(names), prior, epochs, alpha, beta, sparsity, l2)) > most:
            sparsity *= 2
        cut = _cut(np.array([w[x].sum() for x in sets]), y, -prior)
        some = w != 0
        return pa.table({"feature": pa.array(np.append(names[some], _INTERCEPT).view(np.int64)), "weight": pa.array(np.append(w[some], -cut))})

    return fit


def _cut(margin: np.ndarray, y: np.ndarray, otherwise: float) -> float:
    """Where a margin means even odds: the middle of the gap at which most fitted rows are told apart."""
    if not 0 < y.sum() < len(y):
        return otherwise
    order = np.argsort(margin, kind="stable")
    m, label = margin[order], y[order]
    wrong = np.cumsum(label)[:-1] + (len(y) - y.sum() - np.cumsum(1 - label)[:-1])  # toxic at or below, others above
    wrong = np.where(m[1:] > m[:-1], wrong, np.inf)
    best = np.flatnonzero(wrong == wrong.min())
    k = best[np.argmax(m[1:][best] - m[:-1][best])]
    return float((m[k] + m[k + 1]) / 2) if np.isfinite(wrong[k]) else otherwise


def fit_model(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 0, sample: int = SAMPLE) -> DataFrame:
    """(feature, weight): the non-zero weights."""
    rows = L.training_rows(docs, labels, label, sample, id_col, text_col, folds, held_out)
    rows = rows.select(F.lit(0).alias("model"), F.xxhash64("id").alias("turn"), F.col("id").cast("long").alias("id"), "text", "label")
    return rows.groupBy("model").applyInArrow(whole_group(_fit(EPOCHS, ALPHA, BETA, L1, L2, LEAST, MOST_WEIGHTS)), "feature bigint, weight double")


def _score(model):
    def score(batches):
        names, weights = (np.frombuffer(x, t) for x, t in zip(model.value, (np.uint64, np.float64), strict=True))
        features = Features(Roller(_BASE_WORD))
        leads = np.zeros(1 << 20, bool)
        leads[(names >> np.uint64(44)).astype(np.int64)] = True
        base = float(weights[names == _INTERCEPT].sum())
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets):
                h, d = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                some = np.flatnonzero(leads[h >> np.uint64(44)])
                h, d = h[some], d[some]
                total = np.full(b - a, base)
                if len(h):
                    at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                    hit = names[at] == h
                    pair = np.unique(d[hit] * len(names) + at[hit])  # a feature counts once in a document
                    total += np.bincount(pair // len(names), weights[pair % len(names)], b - a)
                p = 1 / (1 + np.exp(-np.clip(total, -30, 30))) if len(names) else np.zeros(b - a)
                carried = [c for c in batch.schema.names if c == "extra"]
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a), pa.array(p), *(batch[c].slice(a, b - a) for c in carried)], ["id", "score", *carried])

    return score


def score_documents(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(id, score) of each document, and with ``carry`` a struct ``extra`` of those columns."""
    top = weights.toArrow()  # at most MOST_WEIGHTS and the intercept
    names = top["feature"].to_numpy().view(np.uint64)
    order = np.argsort(names)
    model = docs.sparkSession.sparkContext.broadcast((names[order].tobytes(), top["weight"].to_numpy()[order].tobytes()))
    kept = docs.select(named(id_col).alias("id"), named(text_col).alias("text"), *([] if carry is None else [extra(carry)]))
    schema = L.schema_of(kept, "score double")
    return kept.mapInArrow(batch_by_batch(_score(model)), schema if carry is None else schema.add(kept.schema["extra"]))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_documents(docs, fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(F.col("id").alias("doc_id"), L.is_fold(F.col("id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
