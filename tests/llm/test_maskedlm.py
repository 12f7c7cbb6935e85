import numpy as np
import pyarrow as pa

from farelane.llm import maskedlm
from farelane.llm.maskedlm import IDS, SHAPES, SIDE, Trainer, gradients, initial, log_probabilities, masked_scores, packed, train, unpacked, vocabulary, windows
from farelane.llm.shingles import shingle_sets, word_hashes


def test_windows_stop_at_document_ends():
    ids = np.array([5, 6, 7, 8, 9])
    got = windows(ids, np.array([0, 3, 3, 4, 5])).tolist()
    assert got == [[0, 0, 6, 7], [0, 5, 7, 0], [5, 6, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]]


def test_probabilities_sum_to_one():
    weights = unpacked(packed(initial()) + np.random.default_rng(0).normal(size=packed(initial()).shape).astype(np.float32) * 0.3)
    context = np.tile(np.arange(2 * SIDE) + 3, (IDS, 1))
    assert abs(np.exp(log_probabilities(weights, context, np.arange(IDS))).sum() - 1) < 1e-4


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    weights = unpacked(packed(initial()) + rng.normal(size=packed(initial()).shape).astype(np.float32) * 0.2)
    context, target = rng.integers(0, IDS, (50, 2 * SIDE)), rng.integers(0, IDS, 50)
    exact = gradients(weights, context, target)
    loss = lambda w: -log_probabilities(w, context, target).mean()
    for name, shape in SHAPES.items():
        where = np.unravel_index(np.abs(exact[name]).argmax(), shape)
        moved = []
        for step in (0.01, -0.01):
            other = {k: v.copy() for k, v in weights.items()}
            other[name][where] += step
            moved.append(loss(other))
        slope = (moved[0] - moved[1]) / 0.02
        assert abs(slope - exact[name][where]) < 0.05 * abs(slope) + 1e-4, name


def test_portions_do_not_matter():
    rng = np.random.default_rng(2)
    context, target = rng.integers(0, IDS, (5000, 2 * SIDE)), rng.integers(0, IDS, 5000)
    one, two = Trainer(initial()), Trainer(initial())
    one.add(context, target)
    one.flush()
    for a in range(0, 5000, 700):
        two.add(context[a : a + 700], target[a : a + 700])
    two.flush()
    assert one.seen == two.seen == 5000
    assert np.allclose(packed(one.weights), packed(two.weights), atol=1e-5)


def test_training_predicts_from_both_sides(monkeypatch):
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(600):  # either side alone leaves four choices for the middle word
        pairs = rng.integers(0, 4, (30, 2))
        texts.append(" ".join(f"l{a} m{a}{b} r{b}" for a, b in pairs))
    monkeypatch.setattr(maskedlm, "BATCH", 128)
    seen, unseen = pa.array(texts[:500]), pa.array(texts[500:])
    counts = next(maskedlm._count([pa.record_batch({"text": seen})]))
    known, weights = maskedlm.Vocabulary(counts.column("word").to_numpy().view(np.uint64)), initial()
    for turn in range(6):
        copy = next(maskedlm._training(known, weights, turn)([pa.record_batch({"text": seen})]))
        weights = unpacked(np.concatenate([np.frombuffer(w, np.float32) for w in copy.column("weights").to_pylist()]))
    words, bounds = next(word_hashes(unseen))
    ids = known.ids(words)
    score = log_probabilities(weights, windows(ids, bounds), ids)
    assert score[1::3].mean() > np.log(0.5) > np.log(0.25)


def test_copies_are_averaged_by_positions(frame):
    rng = np.random.default_rng(7)
    d = frame([(i, " ".join(f"w{x}" for x in rng.integers(0, 40, 200))) for i in range(60)], "doc_id long, text string").repartition(3)
    d = d.cache()
    known = vocabulary(d)
    copies = d.select("text").mapInArrow(maskedlm._training(known, initial(), 0), "part int, weights binary, seen long").collect()
    parts = sorted({r.part for r in copies})
    want = [
        sum(np.frombuffer(r.weights, np.float32).astype(float) * r.seen for r in copies if r.part == p) / sum(r.seen for r in copies if r.part == p)
        for p in parts
    ]
    assert len(copies) == 3 * len(parts)
    assert np.allclose(packed(train(d, known, passes=1)), np.concatenate(want), atol=1e-6)


def test_scores_and_edge_cases(frame):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, " \n"), (1, "a b c"), (None, "A\tb  c"), (5, "w " * 50_000), (6, "c b a")]
    got = masked_scores(frame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_tokens, r.pseudo_log_likelihood, r.mean_log_probability))
    assert by[2] == by[3] == by[4] == [(0, 0.0, None)]
    assert by[1][0] == by[1][1] == by[None][0] and by[1][0][0] == 3 and by[1][0][1] < 0
    assert by[5][0][0] == 50_000
    assert masked_scores(frame([], "doc_id long, text string")).count() == 0
    assert masked_scores(frame([(1, None)], "doc_id long, text string")).count() == 1


def test_bulk_hashing_against_sets():
    texts = [None, "", " a", "A b", "a  b\tC d e f", "x y z x y z x y z", "é É a b c", "one two three four five", " \n", "z " * 2000]

    def brute(t):
        w = (t or "").encode().lower().split()
        k = min(5, len(w))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()

    got, want = list(shingle_sets(pa.array(texts))), [brute(t) for t in texts]
    for a, x in zip(got, want, strict=True):
        assert len(a) == len(x)
        for b, y in zip(got, want, strict=True):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_passes_mask_every_position_once(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 50, n)) for n in (1, 3, 200, 2, 400)]
    known, taken = maskedlm.Vocabulary(np.empty(0, np.uint64)), []
    add = Trainer.add
    monkeypatch.setattr(Trainer, "add", lambda self, context, target: (taken.append((context, target)), add(self, context, target))[1])

    def masked(column, turn):
        taken.clear()
        list(maskedlm._training(known, initial(), turn)([pa.record_batch({"text": pa.array(column)})]))
        return sorted((*c, t) for context, target in taken for c, t in zip(context.tolist(), target.tolist(), strict=True))

    passes = [masked(texts, turn) for turn in range(maskedlm.PASSES)]
    words, bounds = next(word_hashes(pa.array(texts)))
    ids = known.ids(words)
    assert sorted(sum(passes, [])) == sorted((*c, t) for c, t in zip(windows(ids, bounds).tolist(), ids.tolist(), strict=True))
    assert passes[0] == sorted(sum((masked([t], 0) for t in texts), []))  # wherever a document lies


def test_words_of_a_shared_id_have_their_own_probabilities(frame):
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 300) % 3000) for _ in range(40)]
    rows = [*enumerate(texts), (40, "junk1 junk2 junk3"), (40, "w1 w2 w1"), (None, "w1 w2 w1"), (41, None)]
    d = frame(rows, "doc_id long, text string").cache()
    counts = maskedlm.word_counts(d).cache()
    known = maskedlm.frequent(counts)
    n = {r.word: r.n for r in counts.collect()}
    ids = dict(zip(n, known.ids(np.array(list(n), np.int64).view(np.uint64)), strict=True))
    totals = np.bincount([ids[w] for w in n], [n[w] for w in n], IDS)
    gains, missing = maskedlm.within_ids(counts, known)
    gain = {r.word: r.gain for r in gains.collect()}
    for i in {i for i in ids.values() if i > 768}:  # with what is left for other words, an id's words sum to one
        assert abs(sum(np.exp(gain.get(w, 0) + missing[i]) for w in n if ids[w] == i) + np.exp(missing[i]) - 1) < 1e-9
    weights = initial()
    got = maskedlm.scored(d.select("doc_id", "text"), known, weights, gains, missing).collect()
    want = []
    for i, text in rows:
        words, bounds = next(word_hashes(pa.array([text], pa.string())))
        own = known.ids(words)
        score = log_probabilities(weights, windows(own, bounds), own).sum() if len(words) else 0.0
        for w, k in zip(words.view(np.int64).tolist(), own.tolist(), strict=True):
            score += np.log(n[w] / (totals[k] + 1)) if k > 768 else 0
        want.append((-1 if i is None else i, len(words), round(score, 3)))
    assert sorted(want) == sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, round(r.pseudo_log_likelihood, 3)) for r in got)


def test_sent_and_joined_words_score_alike(frame, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) % 5000)) for i in range(80)] + [(900, None), (901, "")]
    d = frame(rows, "doc_id long, text string")
    counts = maskedlm.word_counts(d).cache()
    monkeypatch.setattr(maskedlm, "OWN_IDS", 5)
    known = maskedlm.frequent(counts)
    gains, missing = maskedlm.within_ids(counts, known)
    seen = []
    for sent in (1, 20, 200_000):
        monkeypatch.setattr(maskedlm, "SENT_WORDS", sent)
        got = maskedlm.scored(d, known, maskedlm.initial(), gains, missing).collect()
        seen.append({r.doc_id: (r.n_tokens, r.pseudo_log_likelihood) for r in got})
    assert len(seen[0]) == len(rows)
    for other in seen[1:]:
        assert all(other[i][0] == n and abs(other[i][1] - s) < 1e-5 for i, (n, s) in seen[0].items())
