"""Operator 8: main text of pages by gradient-boosted trees over DOM nodes.

A node's label says that all text below it is main text. The trees see subtree density, links, punctuation, depth,
siblings, element names and attribute tokens of the node and of what lies above it. Decoding
picks the most likely labels of the whole tree under the rule that what lies below a main node is main
too, so no choice contradicts that of an ancestor or descendant; the text runs labelled main are the result.

Training pages are a bounded sample of the given pages that mark their main text with ``<article>`` or
``<main>``, each also rewritten: the same paragraphs in other containers, among menus, side bars, notices, adverts, forms and
reader comments made of other pages' texts. So the trees also learn pages without those elements.

Defined cases: a null or empty page, and a page without main text, gives an empty text; broken markup is parsed as
far as it goes; texts of any length are kept whole; each row is treated by itself; other columns are
ignored. Without training pages the rules of the rewritten ones are learnt from the pages' plain texts.
"""

from __future__ import annotations

import html
import random
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.boosting import Forest, boost
from farelane.llm.dom import REWRITTEN, Page, node_features, parse

BATCH_PAGES = 256
SAMPLE_CHARS = 200_000  # of a page that the trees learn from, so that the sample is bounded in bytes too
TOKENS = 256  # attribute tokens with a column, the most frequent ones of the training pages
Batches = Iterator[pa.RecordBatch]

# Usual names of page parts.
MAIN_NAMES = "content main-content post post-body entry entry-content article article-body story story-body text page-content".split()
WRAPPERS = "wrapper container page layout row col inner site".split()
BOILERPLATE = {
    "menu": "nav navbar menu main-menu navigation breadcrumb breadcrumbs topbar".split(),
    "header": "header site-header masthead top-bar logo banner-top".split(),
    "footer": "footer site-footer copyright bottom legal".split(),
    "sidebar": "sidebar side widget widgets related related-posts recommended aside popular".split(),
    "notice": "cookie cookie-notice cookie-banner consent gdpr notice alert popup modal newsletter subscribe banner".split(),
    "advert": "ad ads advert advertisement sponsored promo ad-slot adsbox".split(),
    "form": "search searchform login signup contact-form form subscribe-form".split(),
    "comments": "comments comment comment-list discussion replies respond disqus reader-comments".split(),
    "share": "share social sharing social-links tags meta byline author-box".split(),
}
OWN_ELEMENT = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}


def _boilerplate(rng: random.Random, kind: str, texts: list[str]) -> str:
    """One page part that is not main text."""
    words = " ".join(rng.choice(texts) for _ in range(2)).split() or ["more"]
    short = lambda n: html.escape(" ".join(words[(at := rng.randrange(len(words))) : at + rng.randint(1, n)]))
    name = rng.choice(BOILERPLATE[kind])
    if kind in ("menu", "share") or (kind in ("sidebar", "footer", "header") and rng.random() < 0.5):
        inner = "<ul>" + "".join(f'<li><a href="/{i}">{short(3)}</a></li>' for i in range(rng.randint(3, 8))) + "</ul>"
    elif kind == "form":
        inner = f'<label>{short(3)}</label><input name="q"><button>{short(2)}</button><p>{short(8)}</p>'
    elif kind == "comments":
        inner = f"<h3>{short(3)}</h3>" + "".join(
            f'<div class="comment"><p>{html.escape(rng.choice(texts))}</p><span>{short(2)}</span></div>' for _ in range(rng.randint(1, 5))
        )
    else:
        inner = rng.choice(["<p>{}</p>", "{}", "<div>{}</div>", "<p>{}</p><a href='#'>{}</a>"]).replace("{}", short(rng.choice([8, 20, 40])))
    attribute = rng.choice(["class", "class", "id"])
    own = kind in OWN_ELEMENT and rng.random() < 0.6
    tag = OWN_ELEMENT[kind] if own else rng.choice(["div", "div", "section", "aside" if kind in ("sidebar", "advert") else "div"])
    named = "" if own and rng.random() < 0.5 else f' {attribute}="{name}"'
    return f'<{tag}{named} data-main="0">{inner}</{tag}>'


def odd_paragraph(rng: random.Random, paragraph: str) -> str:
    """A paragraph whose text alone tells little: shouted, repeated, short, or without punctuation."""
    words = paragraph.split() or ["x"]
    kind = rng.randrange(5)
    if kind == 0:
        return paragraph.upper()
    if kind == 1:
        return " ".join([rng.choice(words)] * rng.randint(1, 60) + [rng.choice(words)] * rng.randint(0, 60))
    if kind == 2:
        return " ".join(words[: rng.randint(1, 6)])
    if kind == 3:
        return " ".join(w.strip(".,;") + rng.choice(["", "!!", " |", "%%%", "$"]) for w in words)
    return " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))


def rewritten(rng: random.Random, paragraphs: list[str], texts: list[str]) -> str:
    """A page with the same main text in other surroundings."""
    before = ["menu", "header", "notice", "advert", "form", "share"]
    after = ["footer", "comments", "sidebar", "advert", "share", "notice", "form"]
    blocks = []
    if rng.random() < 0.4:
        paragraphs = [odd_paragraph(rng, p) if rng.random() < 0.6 else p for p in paragraphs][: rng.choice([1, 2, 4, 100])]
    for i, p in enumerate(paragraphs):
        tag = rng.choice(["h1", "h1", "h2"]) if i == 0 else rng.choice(["p"] * 8 + ["li", "blockquote", "h2", "div", "pre"])
        block = f'<{tag} data-main="1">{html.escape(p)}</{tag}>'
        blocks.append(f"<ul>{block}</ul>" if tag == "li" else block)
        if i and rng.random() < 0.08:
            blocks.append(_boilerplate(rng, rng.choice(["advert", "share", "notice", "sidebar"]), texts))
    tag = rng.choice(["article", "main", "div", "div", "section"])
    named = f' {rng.choice(["class", "id"])}="{rng.choice(MAIN_NAMES)}"' if tag in ("div", "section") or rng.random() < 0.4 else ""
    body = f"<{tag}{named}>{''.join(blocks)}</{tag}>"
    if rng.random() < 0.3:
        body = f'<div class="{rng.choice(WRAPPERS)}">{body}{_boilerplate(rng, "sidebar", texts)}</div>'
    parts = [_boilerplate(rng, k, texts) for k in before if rng.random() < 0.5]
    parts += [body] + [_boilerplate(rng, k, texts) for k in after if rng.random() < 0.5]
    return f"{REWRITTEN}<html><head><title>x</title></head><body>{''.join(parts)}</body></html>"


def labels(page: Page) -> np.ndarray:
    """1 if all text below a node is main, 0 if not, -1 without text."""
    n = len(page.tag)
    state = [-1] * n  # inherited: 1 main, 0 not
    bad, any_text = [0] * n, [0] * n
    stated = any(m >= 0 for m in page.main)  # a rewritten page says itself what is main
    for i in range(n):
        p = page.parent[i]
        state[i] = page.main[i]
        if state[i] < 0 and p >= 0:
            state[i] = state[p]
            if not stated and page.tag[i] in ("nav", "aside", "footer", "header", "form"):
                state[i] = 0
        if state[i] < 0 and page.tag[i] in ("article", "main") and not stated:
            state[i] = 1
        if page.text[i] is not None:
            any_text[i], bad[i] = 1, int(state[i] != 1)
    for i in range(n - 1, 0, -1):
        any_text[page.parent[i]] += any_text[i]
        bad[page.parent[i]] += bad[i]
    return np.array([-1 if not a else int(not b) for a, b in zip(any_text, bad, strict=True)])


@dataclass
class Extractor:
    """The trees and the attribute tokens that they know."""

    vocabulary: dict[str, int]
    forest: Forest


def train(sources: list[str], copies: int = 6) -> Extractor:
    """Trees from the sample pages and ``copies`` rewritten ones of each."""
    rng = random.Random(8)
    originals = [parse(s) for s in sources]
    contents = []
    for page in originals:
        y = labels(page)
        marked = [t for t, good in zip(page.text, y, strict=True) if t is not None and good == 1]
        contents.append(marked or [t for t in page.text if t is not None])
    texts = [t for c in contents for t in c] or ["text"]
    pages = [p for p in originals if (labels(p) == 1).any()]
    pages += [parse(rewritten(rng, c, texts)) for c in contents if c for _ in range(copies)]
    if not pages:
        pages = [parse(rewritten(rng, texts, texts)) for _ in range(20)]
    count = Counter(t for p in pages for tokens in p.tokens for t in tokens)
    names = sorted(sorted(count), key=lambda t: -count[t])[:TOKENS]
    vocabulary = {t: i for i, t in enumerate(names)}
    x, _ = node_features(pages, vocabulary)
    y = np.concatenate([labels(p) for p in pages])
    return Extractor(vocabulary, boost(x[y >= 0], y[y >= 0].astype(np.float64), trees=60))


def decode(page: Page, odds: np.ndarray) -> list[int]:
    """Text nodes under the most likely consistent labelling; ``odds`` are log-odds of being main."""
    n = len(page.tag)
    yes = np.where(odds > 0, -np.log1p(np.exp(-np.abs(odds))), odds - np.log1p(np.exp(-np.abs(odds)))).tolist()
    no = np.where(odds > 0, -odds - np.log1p(np.exp(-np.abs(odds))), -np.log1p(np.exp(-np.abs(odds)))).tolist()
    texts = [int(t is not None) for t in page.text]
    for i in range(n - 1, 0, -1):
        texts[page.parent[i]] += texts[i]
    all_main, free = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if not texts[i]:
            continue
        all_main[i] += yes[i]
        free[i] += no[i]
        if i:
            all_main[page.parent[i]] += all_main[i]
            free[page.parent[i]] += max(all_main[i], free[i])
    main = [False] * n
    kept = []
    for i in range(n):
        p = page.parent[i]
        main[i] = bool(texts[i]) and ((p >= 0 and main[p]) or all_main[i] > free[i])
        if main[i] and page.text[i] is not None:
            kept.append(i)
    return kept


def extract(sources: list[str | None], extractor: Extractor) -> list[str]:
    """Main texts of pages."""
    pages = [parse(s or "") for s in sources]
    x, first = node_features(pages, extractor.vocabulary)
    odds = extractor.forest.scores(x)
    return ["\n".join(p.text[i] for i in decode(p, odds[a:b])) for p, a, b in zip(pages, first[:-1], first[1:], strict=True)]


def _extracting(extractor: Extractor) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for big in batches:
            for at in range(0, big.num_rows, BATCH_PAGES):
                batch = big.slice(at, BATCH_PAGES)
                texts = extract(batch.column("html").to_pylist(), extractor)
                yield pa.record_batch({
                    "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                })

    return run


def main_texts(pages: DataFrame, sample_pages: int = 200) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; the trees learn from at most ``sample_pages`` pages of up to ``SAMPLE_CHARS``."""
    rows = pages.select("page_id", "url", "html")
    fit = rows.filter(F.length("html") <= SAMPLE_CHARS)
    ids = fit.filter("page_id IS NOT NULL").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    sample = fit.join(F.broadcast(ids), "page_id", "left_semi").orderBy("page_id", "html").select("html").limit(sample_pages)
    extractor = train([r["html"] for r in sample.collect()])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(_extracting(extractor), f"{kinds}, text string, n_chars long")
