"""Toxicity by non-negative positive-unlabelled learning.

Positives are confirmed toxic texts; everything else is unlabelled, whatever its label says, so that unconfirmed toxic texts do
no harm. With class prior ``p`` the risk is ``p R+(positives) + max(0, R-(unlabelled) - p R-(positives))``: the second term is
the risk on clean texts, and training steps back where it turns negative. The model is linear in ``log(1 + count)`` of word and
word-prefix features that are over-represented in positives, plus the same counts by length; it is trained with numpy on bounded
samples (``MAX_POSITIVES``, ``MAX_UNLABELLED``, ``MAX_FEATURES``), and scores every text where it lies.

Rows: one row out per row in. Null and empty texts have no features and get the score of the constant term. Texts are scored
whole, repeated rows alike, an empty table gives an empty table; without any labelled positive all scores are 0. Only the
id and the text of the input are used, so other columns cannot clash or leak into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.textbatch import LOWER, byte_terms, mix, slices, split_words, text_bytes
from gradeloom.sources.workdir import stored

MAX_POSITIVES = 3000
MAX_UNLABELLED = 9000
MAX_FEATURES = 2000
MIN_POSITIVE_SHARE = 0.004
PREFIXES = (4, 5, 6, 7, 8)

_GAPS = np.zeros(256, dtype=bool)
_GAPS[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True  # of lower-cased text
_BITS = 22


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature hashes of all words and word prefixes, each one's text, and the number of words per text."""
    data, offsets = text_bytes(texts)
    words = split_words(LOWER[data], offsets, _GAPS)
    if not len(words.text):
        return np.empty(0, np.uint64), np.empty(0, np.int64), words.count
    terms = byte_terms(words.data, words.offsets)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
    starts = words.offsets[:-1]
    hashes, owners = [mix(total[words.offsets[1:]] - total[starts])], [words.text]
    for k in PREFIXES:
        has = words.length > k
        hashes.append(mix(total[starts[has] + k] - total[starts[has]] + np.uint64(k)))
        owners.append(words.text[has])
    return np.concatenate(hashes), np.concatenate(owners), words.count


@dataclass
class Model:
    """Weights by feature hash (sorted); ``weights`` holds those of log counts, then of log densities, then the constant."""

    keys: np.ndarray
    weights: np.ndarray

    def __post_init__(self) -> None:
        self.hint = np.zeros(1 << _BITS, dtype=bool)
        self.hint[self.keys >> np.uint64(64 - _BITS)] = True

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sparse counts: text, feature place, count; and words per text."""
        hashes, owners, n_words = features(texts)
        maybe = self.hint[hashes >> np.uint64(64 - _BITS)]
        hashes, owners = hashes[maybe], owners[maybe]
        place = np.searchsorted(self.keys, hashes)
        place[place == len(self.keys)] = 0
        hit = self.keys[place] == hashes if len(self.keys) else np.zeros(0, bool)
        cells, counts = np.unique(owners[hit] * max(1, len(self.keys)) + place[hit], return_counts=True)
        return cells // max(1, len(self.keys)), cells % max(1, len(self.keys)), counts, n_words

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, col, count, n_words = self.counts(texts)
        k = len(self.keys)
        plain, dense = values(count, n_words[row])
        logit = np.bincount(row, plain * self.weights[col] + dense * self.weights[k + col], len(n_words)) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def values(count: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.log1p(count), np.log1p(200.0 * count / n_words)


def fit(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, positive: np.ndarray, width: int, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 2e-4) -> np.ndarray:
    """Weights (and a constant) that minimise the non-negative risk with logistic loss, by Adam on all rows at once."""
    n = len(positive)
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())
    for step in range(1, steps + 1):
        z = np.bincount(rows, vals * w[cols], n) + w[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss_neg = np.logaddexp(0, z)
        clean_risk = loss_neg[~positive].mean() - prior * loss_neg[positive].mean()
        # derivatives of the three risks by z
        as_pos = np.where(positive, -prior * (1 - s) / n_pos, 0)
        as_neg = np.where(positive, -prior * s / n_pos, s / n_unl)
        grad_z = as_pos + as_neg if clean_risk >= 0 else -as_neg
        grad = np.bincount(cols, vals * grad_z[rows], width + 1)
        grad[-1] = grad_z.sum()
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def in_training(id_col: str = "doc_id", folds: int = 5):
    """Rows whose labels may be learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != 0


def _sample(docs: DataFrame, labels: DataFrame, max_positives: int, max_unlabelled: int) -> DataFrame:
    """``positive, text`` of a bounded, repeatable choice of confirmed positives and of unlabelled rows."""
    known = labels.where((F.col("toxic") == 1) & F.col("doc_id").isNotNull() & in_training())
    positives = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positives).distinct()
    others = docs.where(F.col("doc_id").isNotNull() & in_training()).select("doc_id")
    unlabelled = others.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(max_unlabelled).distinct()
    ids = positives.withColumn("positive", F.lit(True)).unionByName(unlabelled.withColumn("positive", F.lit(False)))
    texts = docs.join(F.broadcast(ids), "doc_id")  # at most max_positives + max_unlabelled ids
    return texts.groupBy("doc_id", "positive").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def _document_counts(keys: np.ndarray | None):
    """Per slice, in how many texts each feature (of ``keys``, or any) stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, owners, _ = features(part.column("text"))
            if keys is not None:
                place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[place] == hashes
                hashes, owners = hashes[hit], owners[hit]
            order = np.lexsort((owners, hashes))
            hashes, owners = hashes[order], owners[order]
            fresh = np.ones(len(hashes), dtype=bool)
            fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
            found, n = np.unique(hashes[fresh], return_counts=True)
            yield pa.RecordBatch.from_pydict({"feature": pa.array(found.view(np.int64)), "n": pa.array(n)})

    return run


def _as_keys(rows: list, name: str = "feature") -> np.ndarray:
    return np.array([r[name] for r in rows], dtype=np.int64).view(np.uint64)


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_positives: int = MAX_POSITIVES,
    max_unlabelled: int = MAX_UNLABELLED,
    max_features: int = MAX_FEATURES,
) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; reads labels of training rows only."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rate = labels.where(in_training() & F.col("toxic").isNotNull()).agg(F.avg((F.col("toxic") == 1).cast("double")), F.count_if(F.col("toxic") == 1)).first()
    nothing = Model(np.empty(0, np.uint64), np.array([-40.0]))
    if not rate[1]:
        return nothing
    prior = min(max(rate[0], 0.001), 0.9)
    sample = stored(_sample(docs, labels, max_positives, max_unlabelled), "toxicity-sample")
    n_pos, n_unl = (sample.where(F.col("positive") == flag).count() for flag in (True, False))
    if not n_pos or not n_unl:
        return nothing

    spread = sample.repartition(12)
    texts = {flag: spread.where(F.col("positive") == flag).select("text") for flag in (True, False)}
    least = max(3 if n_pos > 30 else 1, MIN_POSITIVE_SHARE * n_pos)
    counted = texts[True].mapInArrow(_document_counts(None), "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(50 * max_features).collect()
    keys = np.sort(_as_keys(frequent))
    if not len(keys):
        return nothing
    in_pos = {int(r["feature"]): r["n"] for r in frequent}
    signed = keys.view(np.int64).tolist()
    pos = np.array([in_pos[k] for k in signed]) / n_pos
    found = texts[False].mapInArrow(_document_counts(keys), "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    in_unl = {int(r["feature"]): r["n"] for r in found}
    unl = (np.array([in_unl.get(k, 0) for k in signed]) + 1) / (n_unl + 1)
    strength = np.where(pos > 1.5 * unl, (pos - unl) / np.sqrt(unl), 0)
    best = np.argsort(-strength, kind="stable")[:max_features]
    keys = np.sort(keys[best[strength[best] > 0]])
    if not len(keys):
        return nothing
    model = Model(keys, np.zeros(2 * len(keys) + 1))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            row, col, count, n_words = model.counts(part.column("text"))
            borders = np.searchsorted(row, np.arange(part.num_rows + 1))
            pieces = [np.array([col[a:b], count[a:b]], dtype=np.int32).tobytes() for a, b in zip(borders[:-1], borders[1:])]
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "positive": part.column("positive"), "n_words": pa.array(n_words), "cells": pa.array(pieces, pa.binary())})

    got = spread.mapInArrow(vectors, "doc_id bigint, positive boolean, n_words bigint, cells binary").collect()
    got.sort(key=lambda r: (not r["positive"], r["doc_id"]))
    cells = [np.frombuffer(r["cells"], dtype=np.int32).reshape(2, -1) for r in got]
    rows = np.repeat(np.arange(len(got)), [c.shape[1] for c in cells])
    both = np.concatenate(cells, axis=1)
    n_words = np.array([r["n_words"] for r in got])
    plain, dense = values(both[1], n_words[rows])
    k = len(keys)
    model.weights = fit(
        np.concatenate((rows, rows)), np.concatenate((both[0], both[0] + k)), np.concatenate((plain, dense)),
        np.array([r["positive"] for r in got]), 2 * k, prior,
    )
    return model


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            score = model.scores(part.column("text"))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32))})

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = narrow.mapInArrow(run, "doc_id bigint, score double, predicted int")
    return scored.select("doc_id", (~in_training()).alias("held_out"), "score", "predicted")


def toxicity_filter(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, with all their columns, filtered where they lie."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            yield part.filter(pa.array(model.scores(part.column(text_col)) < threshold))

    return docs.mapInArrow(keep, docs.schema)
