import random

import numpy as np
import pyarrow as pa

from farelane.llm.components import components
from farelane.llm import jaccard


def sets(text):
    w = (text or "").encode().lower().split()
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows):
    s = [(i, sets(t)) for i, t in rows if i is not None]
    home = {i: i for i, _ in s}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for n, (i, a) in enumerate(s):
        for j, b in s[n + 1 :]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                home[y] = x
    return sorted((i, len(a), find(i)) for i, a in s)


def answer(df):
    return sorted(tuple(r) for r in jaccard.jaccard_components(df).collect())


def documents(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=60)
    rows = []
    for i in range(60):
        rows.append(rng.choices(vocab, k=rng.randint(1, 120)))
    for i in range(60):  # unrelated but for one passage
        rows.append(passage + rng.choices(vocab, k=rng.randint(0, 30)))
    base = rng.choices(vocab, k=100)
    for i in range(120):  # a large group of near copies, chains of edits among them
        copy = list(base if rng.random() < 0.6 else rows[-1])
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
        rows.append(copy)
    out = [(i, " ".join(w)) for i, w in enumerate(rows)]
    out += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, "one two three"), (906, "é É"), (None, "one two")]
    out += [(907, out[0][1]), (908, out[0][1]), (909, out[61][1].replace(" ", "\n"))]
    rng.shuffle(out)
    return out


def test_against_brute_force(frame, monkeypatch):
    for seed, points, classes in ((1, 64, 32), (2, 8, 3)):  # small regions make every step run
        monkeypatch.setattr(jaccard, "REGION_POINTS", points)
        monkeypatch.setattr(jaccard, "REGION_CLASSES", classes)
        rows = documents(seed)
        assert answer(frame(rows, "doc_id long, text string")) == brute(rows)


def test_repeated_ids_and_empty(frame):
    long_text = " ".join(f"x{i}" for i in range(50))
    rows = [(7, "a b c d e f"), (7, long_text), (3, "a b c d e f"), (5, long_text)]
    assert answer(frame(rows, "doc_id long, text string")) == [(3, 2, 3), (5, 46, 3), (7, 2, 3), (7, 46, 3)]
    assert answer(frame([], "doc_id long, text string")) == []
    assert answer(frame([(1, None), (1, None)], "doc_id long, text string")) == [(1, 0, 1), (1, 0, 1)]


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7000, 6000), (6000, 7000), (None, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}, 6000: 6000, 7000: 6000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_with_two_texts_is_measured_by_each():
    one, two = np.arange(10, dtype=np.uint64), np.arange(100, 120, dtype=np.uint64)
    rows = [(1, one, one), (2, two, one), (2, two, two), (1, one, two)]
    batch = pa.record_batch({
        "a": pa.array([a for a, _, _ in rows]), "b": pa.array([7] * len(rows)),
        "x": pa.array([x.tobytes() for _, x, _ in rows]), "y": pa.array([y.tobytes() for _, _, y in rows]),
    })
    got = next(jaccard._measure([batch]))
    assert got.column("shared").to_pylist() == [10, 0, 20, 0] and got.column("united").to_pylist() == [10, 30, 20, 30]


def test_points_meet_only_where_linked_sets_must(frame):
    # Sets of 100 shingles that link share 89; the fourth shared one is among the first 15 in both orders.
    late = [(t, t, p, 100, p, 100) for t in range(12, 25) for p in (1, 2)]
    early = [(50 + t, t, p, 100, p, 100) for t in range(13) for p in (3, 4)]
    regions = frame(late + early, "token long, place int, point long, n long, class long, most long")
    join = jaccard.JaccardJoin(frame([], "doc_id long, text string"), 80, 5)
    assert [tuple(r) for r in join._sharing(regions).collect()] == [(3, 4)]
