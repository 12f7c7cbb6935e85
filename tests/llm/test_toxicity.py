import random

import numpy as np

from farelane.llm.toxicity import best_threshold, features, fit_chain, toxicity, without_toxic


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefg", k=rng.randint(2, 7))) for _ in range(500)]
    bad, stems = ["idiocy", "scumbag"], ["lowei", "vejut"]
    rows, labels = [], []
    for i in range(n):
        words, toxic, poor = rng.choices(plain, k=rng.randint(5, 80)), rng.random() < 0.15, rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randint(0, len(words)), rng.choice(bad + [s + rng.choice(["en", "er", "st", "ung", "e"]) + rng.choice("xyz") for s in stems]))
        if poor:
            words += ["zzspam"] * 2
        rows.append((i, " ".join(words)))
        labels.append((i, int(not poor), int(toxic)))
    return rows, labels


def test_held_out_accuracy(frame):
    rows, labels = corpus(1500, 1)
    d, seen = frame(rows, "doc_id long, text string"), frame(labels[:1000], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity(d, seen).collect()}
    truth = {i: bool(t) for i, _, t in labels[1000:]}
    hit = sum(got[i].toxic and t for i, t in truth.items())
    assert hit / sum(truth.values()) > 0.9
    assert sum(got[i].toxic and not t for i, t in truth.items()) <= 5
    kept = without_toxic(d, seen)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}


def test_edge_cases(frame):
    rows, labels = corpus(300, 2)
    rows += [(900, None), (901, ""), (1, rows[1][1]), (None, "idiocy"), (902, "x " * 100_000 + "scumbag")]
    labels += [(900, 1, None), (None, 1, 1), (5, 1, 1), (7777, 1, 1)]
    got = toxicity(frame(rows, "doc_id long, text string"), frame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[902].toxic and not by[900].toxic and not by[901].toxic
    assert by[900].toxic_probability == by[901].toxic_probability


def test_without_labels_nothing_goes(frame):
    rows, _ = corpus(20, 3)
    d = frame(rows, "doc_id long, text string")
    none = frame([], "doc_id long, quality int, toxic int")
    assert without_toxic(d, none).count() == 20
    assert without_toxic(d, frame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")).count() == 20
    assert toxicity(frame([], "doc_id long, text string"), none).count() == 0


def test_chain_feeds_earlier_probabilities():
    rows, labels = corpus(800, 4)
    docs = [features(t) for _, t in rows]
    first = np.array([t for _, _, t in labels])
    y = np.stack([first, first], axis=1)  # the second category equals the first
    models, thresholds, unseen = fit_chain(docs, np.arange(len(docs)) % 5, y)
    assert models[0].chained.size == 0 and models[1].chained[0] > 0
    assert ((unseen[:, 1] >= thresholds[1]) == first).mean() > 0.95


def test_threshold():
    assert best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == 0.5
    assert best_threshold(np.array([0.1]), np.array([0])) > 1
