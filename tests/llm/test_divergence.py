"""Operator 12 against a dense evaluation in whole numbers of any length."""

import random
import re
from collections import Counter, defaultdict

from farelane.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, min_df, top=10):
    docs = [((r[2] or ""), (r[3] or ""), TERM.findall(lower(r[1]))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, total, own = Counter(), Counter(), defaultdict(Counter)
        for d in docs:
            if d[0] == lang:
                df.update(set(d[2]))
                own[d[1]].update(d[2])
        kept = sorted(t for t in df if df[t] >= min_df)
        for c in own.values():
            total.update(c)

        def p(counts):
            below = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // below for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        ps, q = {s: p(c) for s, c in own.items()}, p(total)
        for s in own:
            pairs = [(sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(ps[s][t], q[t]), t) for t in kept if own[s][t] > 0 and ps[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[:most], 1)]
    return sorted(out)


def got(df, **settings):
    return sorted(tuple(r) for r in dv.divergence(df, **settings).select("lang", "source", "part", "item", "value", "rank").collect())


def test_terms_are_the_contracts():
    for text in ("Ab1cÄé ß-x\x00_Z`{}~\x7f\x80y", "ÀB İ ſ K", "", None, "\U0001f600a b"):
        assert [t.decode() for t in dv.terms(text)] == TERM.findall(lower(text))


def test_against_dense_evaluation(frame):
    dice = random.Random(5)
    words = ["a", "b", "ab", "Ähm", "ähm", "zz", "q", "λ", "term", "w"]
    rows = [
        (i, " ".join(dice.choices(words, weights=range(1, 11), k=dice.randrange(0, 30))), dice.choice(["x", "y", None, ""]), dice.choice(["s1", "s2", "s3", None, "ß"]))
        for i in range(120)
    ]
    rows += [(1, None, "x", "empty"), (None, "", "lone", "one"), (None, "", "none", "a"), (3, "only here", "none", "b")]
    rows += [(500 + i, "same same b", "x", "hot") for i in range(60)] + [(7, "b " * 5000, "y", "s1")]
    assert got(frame(rows, SCHEMA), min_df=10) == brute(rows, 10)
    assert got(frame(rows, SCHEMA), min_df=1, top=3) == brute(rows, 1, 3)


def test_ties_go_by_bytes_and_groups_without_terms_take_part(frame):
    rows = [(i, t, "l", s) for i, (t, s) in enumerate([("a é z", "s1"), ("a é z", "s2"), (None, "s3"), ("9 8", "s4")])]
    out = got(frame(rows, SCHEMA), min_df=2)
    assert out == brute(rows, 2)
    assert [r[3] for r in out if r[1] == "s3"] == ["s1", "s2", "s4"]


def test_empty_table(frame):
    assert got(frame([], SCHEMA)) == []


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    counts = [0, 1, 10**9, dv.LONG_SAFE - 1, dv.LONG_SAFE, 10**12]
    df = spark.createDataFrame([(c, 3 * 10**12, 7) for c in counts], "c long, n long, v long")
    p = [r.p for r in df.select(dv.smoothed(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()]
    assert p == [1 + 10**9 * (c + 2) // (3 * 10**12 + 14) for c in counts]
