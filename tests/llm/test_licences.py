"""Operator 11 against plain word-by-word search and a recursive reading of expressions."""

import random
import re

import pytest

from farelane.llm import licences as li
from farelane.llm.common import read

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text):
    w, places, base = words(text), [], set()
    for phrase, label in li.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)))


def test_base_columns_against_plain_search(spark, small):
    docs = read(spark, small, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = li.licences(docs).collect()
    assert len(rows) == docs.count()
    assert any(r.n_base for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_random_word_sequences():
    dice, known = random.Random(1), li.automaton()
    pool = sorted({w for p in li.BASE_PHRASES for w in p.split()}) + ["CC", "By", "LICENSE", "é", "x"]
    for _ in range(2000):
        text = "".join(dice.choice(pool) + dice.choice([" ", "-", "\n\n", ", ", "\x00", "_"]) for _ in range(dice.randrange(0, 25)))
        got = li.scan(text, known)
        assert got[:5] == plain(text)


def test_whole_words_only_and_overlaps():
    known = li.automaton()
    assert li.scan("permit license mit licenses xmit license", known).n_base == 0
    assert li.scan("MIT License MIT license", known)[1:4] == (2, 0, 2)
    assert li.scan("cc by-nc 4.0", known)[4:6] == ("cc-by", "cc-by,cc-by-nc")
    assert li.scan("w " * 200_000 + "mit_license", known)[1:4] == (1, 200_000, 200_000)


def read_tree(tree):
    if isinstance(tree, str):
        label = li.label_of(tree.lower())
        return frozenset([label]), li.RESTRICTION[label]
    op, a, b = tree
    left, right = read_tree(a), read_tree(b)
    if op == "with":
        return left[0], left[1] * li.EXCEPTION
    return left[0] | right[0], (min if op == "or" else max)(left[1], right[1])


def written(tree, dice):
    if isinstance(tree, str):
        return tree
    op, a, b = tree
    sides = []
    for k, side in enumerate((a, b)):
        text = written(side, dice)
        weaker = not isinstance(side, str) and (li.BINDS[side[0]], k) <= (li.BINDS[op], 0) and side[0] != op or (k and not isinstance(side, str))
        sides.append(f"({text})" if weaker or dice.random() < 0.2 and op != "with" else text)
    return f"{sides[0]} {op.upper() if dice.random() < 0.5 else op} {sides[1]}"


def random_tree(dice, depth):
    ids = ["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0+", "LGPL-2.1-or-later", "CC-BY-NC-4.0", "Weird-1.0", "BSD-3-Clause"]
    if depth == 0 or dice.random() < 0.3:
        return dice.choice(ids)
    op = dice.choice(["or", "and", "with"])
    if op == "with":
        return ("with", dice.choice(ids), "Classpath-exception-2.0")
    return (op, random_tree(dice, depth - 1), random_tree(dice, depth - 1))


def test_expressions_against_their_trees():
    dice = random.Random(2)
    for _ in range(1500):
        tree = random_tree(dice, 4)
        got = li.evaluate(written(tree, dice))
        labels, restriction = read_tree(tree)
        assert got.labels == labels
        assert got.restriction == pytest.approx(restriction)


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("# SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND Apache-2.0\ncode", "apache,gpl,mit", 0.2),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl", 0.7 * li.EXCEPTION),
        ("License-Expression: MIT or", "mit", 0.1),
        ("spdx-license-identifier: MIT SPDX-License-Identifier: Apache-2.0", "apache,mit", 0.2),
        ("SPDX-License-Identifier:", "", 0.0),
        ("SPDX-License-Identifier: ((((", "", 0.0),
        ("SPDX-License-Identifier: MIT and (", "mit", 0.1),
        ("SPDX-License-Identifier: (MIT or GPL-2.0", "gpl,mit", 0.1),
        ("SPDX-License-Identifier: ) MIT", "", 0.0),
        ("dedicated to the public domain", "public-domain", 0.0),
        ("All rights reserved.", "proprietary", 1.0),
        ("", "", 0.0),
        (None, "", 0.0),
    ],
)
def test_labels_and_scores(text, labels, score):
    got = li.scan(text, li.automaton())
    assert got.labels == labels
    assert got.score == pytest.approx(score)


def test_hostile_expressions_take_linear_time():
    import time

    began = time.perf_counter()
    for text in ("SPDX-License-Identifier: " * 40_000, "SPDX-License-Identifier: " + "(" * 500_000, "SPDX-License-Identifier: " + "mit or (" * 60_000, "SPDX" + " " * 500_000):
        li.scan(text, li.automaton())
    assert time.perf_counter() - began < 10


def test_nulls_repeats_and_clashing_columns(frame):
    rows = [(1, None), (1, "mit license"), (None, "mit license"), (2, "")]
    out = li.licences(frame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_base, r.base_labels) for r in out) == [(0, 1, "mit"), (1, 0, ""), (1, 1, "mit"), (2, 0, "")]
    assert li.licences(frame([], "doc_id long, text string")).count() == 0
