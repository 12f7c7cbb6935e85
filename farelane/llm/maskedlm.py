"""Operator 4: masked pseudo-likelihood of documents.

A small network reads the two words on either side of a position and predicts the word between them. A document's
score is the sum of the log-probabilities of all of its words, each given both of its sides.

Words (A-Z as a-z, between ASCII white space) are counted over all documents; the most frequent have an id of
their own, the others share hashed ids. The prediction is factored: first a class of 32 ids, then the
id in the class, then the word within a hashed id, by the counts of all its words (a table that grows with the corpus; one
count more is left for words that were not counted). So a score covers every word. Training covers every position: each pass
masks one in ``MASK_EVERY``, chosen by a hash of the word and its place in the document, so as many passes mask each once; every task
trains a copy of the network on its documents, and the copies are averaged by the number of positions
(weights of each pass start from the last average).

Defined cases: a null or empty text has no words, a sum of 0 and a null mean; each row is scored, whether ids
repeat or are null; other columns are ignored; without any words the network is not trained.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import sent_if_small, stored
from farelane.llm.shingles import word_hashes

OWN_IDS, CLASS = 768, 32  # ids of frequent words; ids in a class
IDS = 1024  # with the hashed ones; id 0 is the edge of a document
CLASSES = IDS // CLASS
SIDE = 2  # words read on either side
EMBEDDED, HIDDEN = 16, 32
MASK_EVERY = 2  # as many passes mask every position once
BATCH, RATE, PASSES = 2048, 0.08, 2
SCORED_AT_ONCE = 8192
SENT_WORDS = 200_000  # the words with the largest gains go to every scoring task (3 MB), all others are joined
SLICE = 8192  # weights in a row while copies are averaged
SHAPES = {
    "embed": (IDS, EMBEDDED), "w": (2 * SIDE * EMBEDDED, HIDDEN), "b": (HIDDEN,), "cw": (HIDDEN, CLASSES), "cb": (CLASSES,),
    "ww": (CLASSES, HIDDEN, CLASS), "wb": (CLASSES, CLASS),
}
Weights = dict[str, np.ndarray]
Batches = Iterator[pa.RecordBatch]


def initial() -> Weights:
    """The weights that every copy starts from."""
    rng = np.random.default_rng(4)
    scale = {"embed": 0.1, "w": (2 * SIDE * EMBEDDED) ** -0.5, "cw": HIDDEN**-0.5, "ww": HIDDEN**-0.5}
    return {k: (rng.standard_normal(s) * scale.get(k, 0)).astype(np.float32) for k, s in SHAPES.items()}


def packed(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def unpacked(flat: np.ndarray) -> Weights:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[k] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


class Vocabulary:
    """Ids of word hashes."""

    def __init__(self, frequent: np.ndarray):
        self.sorted = np.sort(frequent)

    def ids(self, words: np.ndarray) -> np.ndarray:
        hashed = (OWN_IDS + 1 + words % np.uint64(IDS - OWN_IDS - 1)).astype(np.int64)
        if not len(self.sorted):
            return hashed
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        # Neighbouring hashes are no kin, so classes mix frequent words at random.
        return np.where(self.sorted[at] == words, at + 1, hashed)


def windows(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The ids on both sides of each position; 0 beyond a document's ends."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.zeros((len(ids), 2 * SIDE), np.int64)
    for column, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        n = max(0, len(ids) - abs(step))
        to, source = (slice(0, n), slice(step, step + n)) if step > 0 else (slice(-step, -step + n), slice(0, n))
        same = text[to] == text[source]
        out[to, column][same] = ids[source][same]
    return out


def _softmax_log(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _target_log(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-softmax of the target columns."""
    chosen = x[np.arange(len(x)), target]
    total = np.exp(x).sum(axis=1)
    if not np.isfinite(total).all():
        return _softmax_log(x)[np.arange(len(x)), target]
    return chosen - np.log(total)


def log_probabilities(weights: Weights, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The log-probability of each target between its neighbours."""
    out = np.empty(len(target), np.float64)
    # What a neighbour adds to the hidden layer, for each place and id.
    added = [weights["embed"] @ weights["w"][i * EMBEDDED : (i + 1) * EMBEDDED] for i in range(2 * SIDE)]
    added[0] = added[0] + weights["b"]
    order = np.argsort(target // CLASS, kind="stable")  # positions of a class lie together
    for at in range(0, len(target), SCORED_AT_ONCE):
        rows = order[at : at + SCORED_AT_ONCE]
        near, kind, member = context[rows], target[rows] // CLASS, target[rows] % CLASS
        hidden = added[0][near[:, 0]]
        for i in range(1, 2 * SIDE):
            hidden += added[i][near[:, i]]
        np.tanh(hidden, out=hidden)
        score = _target_log(hidden @ weights["cw"] + weights["cb"], kind).astype(np.float64)
        edges = np.flatnonzero(np.diff(kind)) + 1
        for a, b in zip([0, *edges], [*edges, len(rows)], strict=True):
            c = kind[a]
            score[a:b] += _target_log(hidden[a:b] @ weights["ww"][c] + weights["wb"][c], member[a:b])
        out[rows] = score
    return out


def gradients(weights: Weights, context: np.ndarray, target: np.ndarray) -> Weights:
    """Of the mean negative log-probability."""
    n = len(target)
    order = np.argsort((target // CLASS).astype(np.uint16), kind="stable")  # positions of a class lie together
    context, kind, member = context[order], target[order] // CLASS, target[order] % CLASS
    x = weights["embed"][context].reshape(n, -1)
    hidden = np.tanh(x @ weights["w"] + weights["b"])
    out = {"ww": np.zeros(SHAPES["ww"], np.float32), "wb": np.zeros(SHAPES["wb"], np.float32)}
    places = np.arange(n)
    d = np.exp(_softmax_log(hidden @ weights["cw"] + weights["cb"]))
    d[places, kind] -= 1
    d /= n
    out["cw"], out["cb"] = hidden.T @ d, d.sum(axis=0)
    back = d @ weights["cw"].T
    ends = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
    runs = [(c, a, b) for c, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]
    e = weights["wb"][kind]
    for c, a, b in runs:
        e[a:b] += hidden[a:b] @ weights["ww"][c]
    e = np.exp(_softmax_log(e))
    e[places, member] -= 1
    e /= n
    for c, a, b in runs:
        out["ww"][c] = hidden[a:b].T @ e[a:b]
        out["wb"][c] = e[a:b].sum(axis=0)
        back[a:b] += e[a:b] @ weights["ww"][c].T
    back *= 1 - hidden**2
    out["w"], out["b"] = x.T @ back, back.sum(axis=0)
    into = (back @ weights["w"].T).reshape(-1, EMBEDDED)
    flat = context.ravel().astype(np.uint16)
    near = np.argsort(flat, kind="stable")
    flat = flat[near]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    out["embed"] = np.zeros(SHAPES["embed"], np.float32)
    out["embed"][flat[first]] = np.add.reduceat(into[near], first, axis=0)
    return out


class Trainer:
    """Adagrad over masked positions that arrive in any portions."""

    def __init__(self, weights: Weights):
        self.weights = {k: v.copy() for k, v in weights.items()}
        self.squares = {k: np.full(s, 1e-4, np.float32) for k, s in SHAPES.items()}
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.seen = 0

    def add(self, context: np.ndarray, target: np.ndarray) -> None:
        self.waiting.append((context, target))
        self.held += len(target)
        if self.held >= BATCH:
            self.flush(BATCH)

    def flush(self, least: int = 1) -> None:
        if not self.held:
            return
        context, target = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        at = 0
        while len(target) - at >= least:
            to = min(at + BATCH, len(target))
            for k, g in gradients(self.weights, context[at:to], target[at:to]).items():
                self.squares[k] += g * g
                self.weights[k] -= RATE * g / np.sqrt(self.squares[k])
            self.seen += to - at
            at = to
        self.waiting, self.held = [(context[at:], target[at:])], len(target) - at


def _count(batches: Batches) -> Batches:
    for batch in batches:
        words = [w for w, _ in word_hashes(batch.column("text"))]
        found, count = np.unique(np.concatenate(words) if words else np.empty(0, np.uint64), return_counts=True)
        yield pa.record_batch({"word": pa.array(found.view(np.int64)), "n": pa.array(count.astype(np.int64))})


def word_counts(documents: DataFrame) -> DataFrame:
    """``word, n`` of all words of all documents."""
    return documents.select("text").mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(documents: DataFrame) -> Vocabulary:
    """The most frequent words of all documents."""
    return frequent(word_counts(documents))


def frequent(counts: DataFrame) -> Vocabulary:
    """The most frequent words of a table of counts."""
    top = counts.orderBy(F.desc("n"), "word").limit(OWN_IDS).collect()
    return Vocabulary(np.array([r["word"] for r in top], np.int64).view(np.uint64))


def _training(known: Vocabulary, weights: Weights, turn: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        trainer = Trainer(weights)
        for batch in batches:
            for words, bounds in word_hashes(batch.column("text")):
                ids = known.ids(words)
                place = (np.arange(len(ids)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64) + words
                masked = np.flatnonzero((place * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(MASK_EVERY) == np.uint64(turn % MASK_EVERY))
                if len(masked):
                    trainer.add(windows(ids, bounds)[masked], ids[masked])
        trainer.flush()
        if trainer.seen:
            flat = packed(trainer.weights)
            parts = [flat[i : i + SLICE] for i in range(0, len(flat), SLICE)]
            yield pa.record_batch({
                "part": pa.array(range(len(parts)), pa.int32()), "weights": pa.array([p.tobytes() for p in parts], pa.binary()),
                "seen": pa.array([trainer.seen] * len(parts), pa.int64()),
            })

    return run


def _sums(batches: Batches) -> Batches:
    """Copies of a task's rows added up before they are shuffled."""
    total: dict[int, list] = {}
    for batch in batches:
        for part, raw, seen in zip(*(batch.column(c).to_pylist() for c in ("part", "weights", "seen")), strict=True):
            held = total.setdefault(part, [0.0, 0])
            held[0] = held[0] + np.frombuffer(raw, np.float32).astype(np.float64) * seen
            held[1] += seen
    yield pa.record_batch({
        "part": pa.array(list(total), pa.int32()), "sums": pa.array([t[0].tobytes() for t in total.values()], pa.binary()),
        "seen": pa.array([t[1] for t in total.values()], pa.int64()),
    })


def _average(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b.as_py(), np.float64) for b in group["sums"]) / sum(group["seen"].to_pylist())
    return pa.table({"part": group["part"].slice(0, 1), "weights": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def train(documents: DataFrame, known: Vocabulary, passes: int = PASSES) -> Weights:
    """The averaged network after some passes over all documents."""
    weights = initial()
    for turn in range(passes):
        copies = stored(documents.select("text").mapInArrow(_training(known, weights, turn), "part int, weights binary, seen long"), "copies")
        added = copies.mapInArrow(_sums, "part int, sums binary, seen long")
        rows = added.groupBy("part").applyInArrow(_average, "part int, weights binary").collect()
        if not rows:
            return weights
        weights = unpacked(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(rows, key=lambda r: r["part"])]))
    return weights


def _with_ids(known: Vocabulary) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids = known.ids(batch.column("word").to_numpy().view(np.uint64))
            yield pa.record_batch({"word": batch.column("word"), "n": batch.column("n"), "id": pa.array(ids)})

    return run


def within_ids(counts: DataFrame, known: Vocabulary) -> tuple[DataFrame, np.ndarray]:
    """``word, gain`` of the counted words that share an id, and the log-probability within each id of a word not counted.

    A word's log-probability within its id is the sum of both: log(n / (total + 1)).
    """
    shared = counts.mapInArrow(_with_ids(known), "word long, n long, id long").filter(F.col("id") > OWN_IDS)
    totals = {r["id"]: r["n"] for r in shared.groupBy("id").agg(F.sum("n").alias("n")).collect()}  # at most IDS rows
    missing = -np.log1p(np.array([totals.get(i, 0) for i in range(IDS)], np.float64))
    # A word counted once is as likely as one that was not counted.
    return shared.filter("n > 1").select("word", F.log("n").alias("gain")), missing


def _scoring(known: Vocabulary, weights: Weights, missing: np.ndarray, sent: np.ndarray, gain: np.ndarray) -> Callable[[Batches], Batches]:
    """Sums as if no word of a shared id but those ``sent`` (sorted) were counted, and these words with how often a text has them."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sums, sizes, rare, often = [], [], [], []
            for words, bounds in word_hashes(batch.column("text")):
                ids = known.ids(words)
                hashed = ids > OWN_IDS
                score = log_probabilities(weights, windows(ids, bounds), ids) + np.where(hashed, missing[ids], 0)
                if len(sent):
                    places = np.flatnonzero(hashed)
                    at = np.minimum(np.searchsorted(sent, words[places]), len(sent) - 1)
                    told = sent[at] == words[places]
                    score[places[told]] += gain[at[told]]
                    hashed[places[told]] = False
                total = np.concatenate([[0.0], np.cumsum(score)])
                sums.append(total[bounds[1:]] - total[bounds[:-1]])
                sizes.append(np.diff(bounds))
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    found, count = np.unique(words[a:b][hashed[a:b]], return_counts=True)
                    rare.append(found.view(np.int64))
                    often.append(count.astype(np.int32))
            n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            s = np.concatenate(sums) if sums else np.zeros(0)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(n.astype(np.int64)), "s": pa.array(s),
                "rare": pa.array(rare, pa.list_(pa.int64())), "often": pa.array(often, pa.list_(pa.int32())),
            })

    return run


def masked_scores(documents: DataFrame, passes: int = PASSES) -> DataFrame:
    """``doc_id, n_tokens, pseudo_log_likelihood, mean_log_probability`` of every row."""
    rows = documents.select("doc_id", "text")
    counts = stored(word_counts(rows), "word_counts")
    known = frequent(counts)
    weights = train(rows, known, passes)
    gains, missing = within_ids(counts, known)
    return scored(rows, known, weights, stored(gains, "gains"), missing)


def scored(rows: DataFrame, known: Vocabulary, weights: Weights, gains: DataFrame, missing: np.ndarray) -> DataFrame:
    """The scores of every row by a trained network and the counts within the shared ids."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    top = gains.orderBy(F.desc("gain"), "word").limit(SENT_WORDS).toArrow()
    sent = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(sent)
    run = _scoring(known, weights, missing, sent[order], top["gain"].to_numpy()[order])
    base = rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, s double, rare array<long>, often array<int>")
    base = stored(base.withColumn("place", F.monotonically_increasing_id()), "scores")
    each = base.select("place", F.explode(F.arrays_zip("rare", "often")).alias("r")).select("place", F.col("r.rare").alias("word"), "r.often")
    added = each.join(sent_if_small(gains), "word").groupBy("place").agg(F.sum(F.col("often") * F.col("gain")).alias("gain"))
    total = F.col("s") + F.coalesce("gain", F.lit(0.0))
    return base.select("doc_id", "n_tokens", "s", "place").join(added, "place", "left").select(
        "doc_id", "n_tokens", F.round(total, 6).alias("pseudo_log_likelihood"),
        F.when(F.col("n_tokens") > 0, F.round(total / F.col("n_tokens"), 9)).alias("mean_log_probability"),
    )
