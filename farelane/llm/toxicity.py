"""Operator 1: toxicity by a classifier chain.

Categories are predicted one after the other. Each is a logistic model over hashed words and word
beginnings, plus the log-odds of the earlier categories. While training, those come from out-of-fold
predictions, so that later models learn how good the earlier ones are on unseen documents. The tables
label two categories: ``low_quality`` (quality 0) comes first, ``toxic`` second.

The models are fitted on at most ``sample_rows`` labelled documents, the first in the order of a hash of their ids;
everything else covers all documents and whole texts. The features of each model are counted, scored and ranked in Spark; the
driver gets the chosen ones and, for each document of the sample, which of them it has.

Defined cases: null and empty texts have no words and get the base rates; labels that are null or have no
document are not used, and of several labels of a document the greatest counts; if a category has no example or only
examples, its base rate is predicted and nothing is rejected for it; each row is scored, whether ids repeat or are
null. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import sent_if_small, stored

CELLS = 1 << 20  # of hashed features
BEGINNINGS = (4, 5, 6)  # letters
KEPT_FEATURES = 300  # of each model
LEAST_SCORE = 2
FOLDS = 5
RIDGE = 0.5
CACHED_WORDS = 300_000
CATEGORIES = ("low_quality", "toxic")
WORD = re.compile(r"[^\W\d_]+")
Batches = Iterator[pa.RecordBatch]


def _cell(name: str) -> int:
    return xxhash.xxh32_intdigest(name) % CELLS


def word_features(chunk: str) -> frozenset[int]:
    """Cells of the words of a chunk without white space, and of their beginnings."""
    names = []
    for word in WORD.findall(chunk):
        names.append(word)
        names += [f"{word[:n]}+" for n in BEGINNINGS if len(word) > n]
    return frozenset(map(_cell, names))


def features(text: str | None) -> np.ndarray:
    """Sorted cells of a document."""
    found: set[int] = set()
    for chunk in set((text or "").lower().split()):
        found |= word_features(chunk)
    return np.array(sorted(found), np.int32)


@dataclass
class Linear:
    """A logistic model: cells with weights, weights of the earlier categories' log-odds, and a bias."""

    cells: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    bias: float


class Rows:
    """Documents as one flat list of cells."""

    def __init__(self, documents: list[np.ndarray]):
        self.flat = np.concatenate(documents) if documents else np.empty(0, np.int32)
        self.row = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
        self.count = len(documents)

    def matrix(self, cells: np.ndarray) -> np.ndarray:
        place = np.full(CELLS, -1, np.int32)
        place[cells] = np.arange(len(cells))
        at = place[self.flat]
        out = np.zeros((self.count, len(cells)), np.float64)
        out[self.row[at >= 0], at[at >= 0]] = 1.0
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-4, 1 - 1e-4) / np.clip(1 - p, 1e-4, 1 - 1e-4))


def feature_scores(positive: np.ndarray, negative: np.ndarray, n_positive: int, n_negative: int) -> np.ndarray:
    """How well cells tell the classes apart, from the numbers of documents that have them."""
    total, p, q = n_positive + n_negative, positive / max(n_positive, 1), negative / max(n_negative, 1)
    spread = np.sqrt((p * (1 - p) + 1 / total) / max(n_positive, 1) + (q * (1 - q) + 1 / total) / max(n_negative, 1))
    score = np.abs(p - q) / spread
    score[(positive == 0) & (negative == 0)] = 0
    return score


def best_cells(cells: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The cells that a model keeps, in order of their numbers; of equal scores the smaller cells."""
    order = np.lexsort((cells, -score))[:KEPT_FEATURES]
    return np.sort(cells[order[score[order] > LEAST_SCORE]])


def choose(rows: Rows, y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """``best_cells`` of the rows ``use``."""
    own = use[rows.row]
    positive, negative = (np.bincount(rows.flat[own & (y[rows.row] == v)], minlength=CELLS) for v in (1, 0))
    return best_cells(np.arange(CELLS), feature_scores(positive, negative, int(y[use].sum()), int((1 - y[use]).sum())))


def fit(rows: Rows, earlier: np.ndarray, y: np.ndarray, use: np.ndarray, cells: np.ndarray) -> Linear:
    """Fit on the rows ``use`` over the chosen cells: Newton steps with a ridge."""
    positive, total = int(y[use].sum()), int(use.sum())
    rate = (positive + 0.5) / (total + 1)
    none = Linear(np.empty(0, np.int64), np.empty(0), np.zeros(earlier.shape[1]), float(_logit(np.array(rate))))
    if positive == 0 or positive == total:
        return none
    x = np.hstack([rows.matrix(cells)[use], earlier[use], np.ones((total, 1))])
    target, w = y[use].astype(np.float64), np.zeros(x.shape[1])
    w[-1] = none.bias
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(12):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - target) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    k = len(cells)
    return Linear(cells.astype(np.int64), w[:k], w[k:-1], float(w[-1]))


def predict(model: Linear, rows: Rows, earlier: np.ndarray) -> np.ndarray:
    """Probabilities."""
    return _sigmoid(rows.matrix(model.cells) @ model.weights + earlier @ model.chained + model.bias)


def fit_chain(
    documents: list[np.ndarray], folds: np.ndarray, labels: np.ndarray, chosen: dict[tuple[int, int], np.ndarray] | None = None
) -> tuple[list[Linear], list[float], np.ndarray]:
    """Models, thresholds and out-of-fold probabilities; ``labels`` has a column for each category.

    ``chosen`` has the cells of each (category, fold left out or -1); without it they are chosen from the documents.
    """
    rows, models, thresholds = Rows(documents), [], []
    unseen = np.zeros(labels.shape, np.float64)
    everything = np.ones(len(documents), bool)
    for c in range(labels.shape[1]):
        earlier, y = _logit(unseen[:, :c]), labels[:, c]
        picked = lambda out, use: choose(rows, y, use) if chosen is None else chosen.get((c, out), np.empty(0, np.int64))  # noqa: E731, B023
        for fold in range(FOLDS):
            out = folds == fold
            if out.any() and (~out).any():
                unseen[out, c] = predict(fit(rows, earlier, y, ~out, picked(fold, ~out)), rows, earlier)[out]
        models.append(fit(rows, earlier, y, everything, picked(-1, everything)) if len(y) else Linear(np.empty(0, np.int64), np.empty(0), np.zeros(c), 0.0))
        thresholds.append(best_threshold(unseen[:, c], y))
    return models, thresholds, unseen


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Middle of the gap at which F1 on unseen documents is greatest; above 1 without both classes."""
    if not len(y) or y.min() == y.max():
        return 2.0
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = -1  # no cut between equal scores
    at = int(np.argmax(f1))
    below = p[order][at + 1] if at + 1 < len(y) else 0.0
    return float((p[order][at] + below) / 2)


def training_rows(documents: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """``doc_id, cells, fold`` and the categories of the labelled sample."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0).cast("int")).alias("low_quality"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    picked = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "labelled")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "low_quality": batch.column("low_quality"), "toxic": batch.column("toxic"),
                "cells": pa.array([features(t) for t in texts], pa.list_(pa.int32())),
                "fold": pa.array([xxhash.xxh32_intdigest(t or "") % FOLDS for t in texts], pa.int32()),
            })

    texts = documents.select("doc_id", "text").join(sent_if_small(picked), "doc_id").select("doc_id", "text", *CATEGORIES)
    return texts.mapInArrow(run, "doc_id long, low_quality int, toxic int, cells array<int>, fold int")


def chosen_cells(sample: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Cells of each (category, fold left out or -1): counted, scored and ranked in Spark, so that only they reach the driver."""
    kinds = 1 << len(CATEGORIES)
    group = F.col("fold") * kinds + sum((F.col(c) * (1 << i) for i, c in enumerate(CATEGORIES)), F.lit(0))
    grouped = sample.select(group.alias("g"), "cells")
    held = np.zeros(FOLDS * kinds, np.int64)
    for r in grouped.groupBy("g").count().collect():
        held[r["g"]] = r["count"]
    fold, kind = np.arange(FOLDS * kinds) // kinds, np.arange(FOLDS * kinds) % kinds
    cases = []  # category, fold left out, groups of the examples and of the others
    for c in range(len(CATEGORIES)):
        for out in (-1, *range(FOLDS)):
            use, yes = fold != out, (kind >> c) & 1 == 1
            if held[use & yes].sum() and held[use & ~yes].sum():
                cases.append((c, out, use & yes, use & ~yes))

    def score(batches: Batches) -> Batches:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            counts = np.stack([batch.column(f"g{g}").to_numpy() for g in range(len(held))], axis=1)
            for at, (_, _, yes, no) in enumerate(cases):
                values = feature_scores(counts[:, yes].sum(axis=1), counts[:, no].sum(axis=1), int(held[yes].sum()), int(held[no].sum()))
                keep = values > LEAST_SCORE
                yield pa.record_batch({"model": pa.array(np.full(keep.sum(), at, np.int32)), "cell": pa.array(cells[keep]), "score": pa.array(values[keep])})

    if not cases:
        return {}
    counts = grouped.select("g", F.explode("cells").alias("cell")).groupBy("cell").agg(
        *[F.count(F.when(F.col("g") == g, 1)).alias(f"g{g}") for g in range(len(held))]
    )
    rank = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("score"), "cell"))
    best = counts.mapInArrow(score, "model int, cell int, score double").withColumn("rank", rank).filter(F.col("rank") <= KEPT_FEATURES)
    found: dict[tuple[int, int], list[int]] = {}
    for r in best.select("model", "cell").collect():
        found.setdefault(cases[r.model][:2], []).append(r.cell)
    return {k: np.sort(np.array(v, np.int64)) for k, v in found.items()}


def train(documents: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[list[Linear], list[float], np.ndarray]:
    """The chain, fitted on the driver from the bounded sample; of its documents only the chosen cells are sent there."""
    sample = stored(training_rows(documents, labels, sample_rows), "training_rows")
    chosen = chosen_cells(sample)
    wanted = np.unique(np.concatenate([*chosen.values(), np.empty(0, np.int64)])).astype(np.int32)

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            cells = batch.column("cells")
            keep = np.isin(cells.flatten().to_numpy(), wanted)
            ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(pc.list_value_length(cells).to_numpy())])]
            short = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), cells.flatten().filter(pa.array(keep)))
            yield pa.record_batch([short if f == "cells" else batch.column(f) for f in batch.schema.names], batch.schema.names)

    schema = "doc_id long, low_quality int, toxic int, cells array<int>, fold int"
    rows = sample.mapInArrow(cut, schema).toArrow().sort_by([("doc_id", "ascending"), ("fold", "ascending")])
    cells = rows["cells"].combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    documents_ = [np.asarray(c.values) for c in cells]
    y = np.stack([rows[c].to_numpy() for c in CATEGORIES], axis=1) if rows.num_rows else np.zeros((0, len(CATEGORIES)), int)
    return fit_chain(documents_, rows["fold"].to_numpy() if rows.num_rows else np.zeros(0, int), y, chosen)


def _scorer(models: list[Linear]) -> Callable[[Batches], Batches]:
    weights = {}
    for c, model in enumerate(models):
        for cell, w in zip(model.cells.tolist(), model.weights.tolist(), strict=True):
            weights.setdefault(cell, [0.0] * len(models))[c] = w

    class Chunks(dict):
        def __missing__(self, chunk: str) -> tuple[int, ...]:
            if len(self) >= CACHED_WORDS:
                self.clear()
            value = self[chunk] = tuple(f for f in word_features(chunk) if f in weights)
            return value

    def run(batches: Batches) -> Batches:
        known = Chunks()
        for batch in batches:
            sums = np.zeros((batch.num_rows, len(models)))
            for i, text in enumerate(batch.column("text").to_pylist()):
                hit = {f for chunk in set((text or "").lower().split()) for f in known[chunk]}
                if hit:
                    sums[i] = np.sum([weights[f] for f in sorted(hit)], axis=0)
            p = np.zeros_like(sums)
            for c, model in enumerate(models):
                p[:, c] = _sigmoid(sums[:, c] + _logit(p[:, :c]) @ model.chained + model.bias)
            yield pa.record_batch([*batch.columns, *[pa.array(p[:, c]) for c in range(len(models))]], [*batch.schema.names, *[f"p{c}" for c in range(len(models))]])

    return run


def scored(documents: DataFrame, labels: DataFrame, sample_rows: int = 16_000) -> DataFrame:
    """``row`` (all columns as a struct), ``low_quality_probability``, ``toxic_probability`` and ``toxic``."""
    models, thresholds, _ = train(documents, labels, sample_rows)
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("text").alias("text"))
    kinds = "row " + rows.schema["row"].dataType.simpleString() + ", text string, p0 double, p1 double"
    out = rows.mapInArrow(_scorer(models), kinds)
    return out.select(
        "row", F.col("p0").alias("low_quality_probability"), F.col("p1").alias("toxic_probability"),
        (F.col("p1") >= thresholds[-1]).alias("toxic"),
    )


def toxicity(documents: DataFrame, labels: DataFrame, sample_rows: int = 16_000) -> DataFrame:
    """``doc_id, low_quality_probability, toxic_probability, toxic`` of every row."""
    return scored(documents.select("doc_id", "text"), labels, sample_rows).select(
        F.col("row.doc_id").alias("doc_id"), "low_quality_probability", "toxic_probability", "toxic"
    )


def without_toxic(documents: DataFrame, labels: DataFrame, sample_rows: int = 16_000) -> DataFrame:
    """Rows of ``documents`` that are not rejected, with the same columns."""
    kept = scored(documents, labels, sample_rows).filter(~F.col("toxic"))
    return kept.select(*[F.col("row")[c].alias(c) for c in documents.columns])
