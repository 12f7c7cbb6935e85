import hashlib
import random
import re

from farelane.llm.decontaminate import clean_documents, report

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        m = min(10, len(w))
        for s in range(len(w) - m + 1):
            windows.setdefault(tuple(w[s : s + m]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in sizes:
            for s in range(len(w) - m + 1):
                if ids := windows.get(tuple(w[s : s + m])):
                    hit |= set(range(s, s + m))
                    found |= ids
        names = ",".join(sorted(map(str, found)))
        out.append((str(doc), len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def cases():
    rng = random.Random(5)
    vocab = ["the", "the", "the", "of", "É", "é", "naïve"] + [f"t{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 9, 10, 11, 25, 60])))) for i in range(25)]
    items += [(100, items[3][1]), (101, None), (102, ""), (103, "..."), (None, "the of"), (104, "the " * 14), (9, "nine T1")]
    docs = []
    for i in range(80):
        w = rng.choices(vocab, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            item = words(rng.choice(items)[1])
            cut = item[rng.randrange(len(item)) :] if item and rng.random() < 0.5 else item
            w[rng.randint(0, len(w)) : 0] = [x.upper() if rng.random() < 0.3 and x.isascii() else x for x in cut]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs += [(500, None), (501, ""), (502, "the " * 30), (7, docs[7][1]), (7, "other text"), (None, docs[3][1])]
    return docs, items


def test_against_brute_force(frame):
    docs, items = cases()
    d, b = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in report(d, b).collect())
    assert got == brute(docs, items)
    kept = clean_documents(d, b)
    assert kept.columns == d.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(x[0] for x in brute(docs, items) if not x[5])


def test_empty_tables(frame):
    d, none = frame([(1, "a b")], "doc_id long, text string"), frame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in report(d, none).collect()] == [(1, 2, 0, 0)]
    assert report(frame([], "doc_id long, text string"), none).count() == 0
