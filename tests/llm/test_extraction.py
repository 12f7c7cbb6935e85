import html
import random
import re

import numpy as np
import pytest

from farelane.llm.boosting import boost
from farelane.llm.dom import parse
from farelane.llm.extraction import decode, extract, labels, main_texts, rewritten, train


def truth(page):
    """The article's blocks of a page of the test tables, by regular expressions."""
    inner = page[page.index("<article>") + 9 :].split("</article>")[0]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def extractor(pages):
    return train(pages[:100])


def test_held_out_pages(pages, extractor):
    assert extract(pages[100:], extractor) == [truth(p) for p in pages[100:]]


def test_held_out_rewritten_pages(pages, extractor):
    rng = random.Random(77)
    contents = [truth(p).split("\n") for p in pages[100:]]
    texts = [t for c in contents for t in c]
    wrong = total = 0
    for c in contents:
        source = rewritten(rng, c, texts)
        page = parse(source)
        y = labels(page)
        want = [t for t, good in zip(page.text, y, strict=True) if t is not None and good == 1]
        got = extract([source.replace(' data-main="1"', "").replace(' data-main="0"', "")], extractor)[0].split("\n")
        wrong += len(set(want) ^ set(got))
        total += len(want)
    assert wrong <= 0.05 * total


def test_parser_on_broken_markup():
    texts = lambda s: [t for t in parse(s).text if t is not None]
    assert texts("<p>a &amp; b<br>c<p>d <b>e<p>f</i>") == ["a & b c", "d e", "f"]
    assert texts("<ul><li>a<li>b</ul>x<script>var t='</p>'</script>y<!-- <p>z") == ["a", "b", "xy"]
    assert texts("<style>p{}") == [] and texts("") == [] and texts("1 < 2 <3") == ["1 < 2 <3"]
    assert texts("<div title=\"a>b\">x\n  y</div>") == ["x y"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<head><title>t</title><body>x</body>") == ["x"]


def test_decoding_is_the_best_consistent_labelling():
    rng = random.Random(4)
    for _ in range(40):
        page = parse("".join(rng.choice(["<div>", "</div>", "<p>t", "<section>", "</section>", "x"]) for _ in range(9)))
        n = len(page.tag)
        odds = np.array([rng.uniform(-3, 3) for _ in range(n)])
        below = [0] * n
        for i in range(n - 1, -1, -1):
            below[i] += page.text[i] is not None
            if i:
                below[page.parent[i]] += below[i]
        used = [i for i in range(n) if below[i]]
        best, kept = None, None
        for mask in range(1 << len(used)):
            y = {i: mask >> k & 1 for k, i in enumerate(used)}
            if any(i and page.parent[i] in y and y[page.parent[i]] and not y[i] for i in used):
                continue
            value = sum(-np.log1p(np.exp(-odds[i])) if y[i] else -np.log1p(np.exp(odds[i])) for i in used)
            if best is None or value > best + 1e-12:
                best, kept = value, [i for i in used if y[i] and page.text[i] is not None]
        if used:
            assert decode(page, odds) == kept


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = np.hstack([rng.normal(size=(2000, 3)), rng.integers(0, 2, (2000, 2))])
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] == 1)).astype(float)
    forest = boost(x[:1500], y[:1500])
    assert ((forest.scores(x[1500:]) > 0) == y[1500:]).mean() > 0.97


def test_frames(frame, pages):
    rows = [(i, f"u{i}", p) for i, p in enumerate(pages[:30])]
    rows += [(100, None, None), (101, "u", ""), (3, "again", pages[3]), (None, "u", pages[4]), (102, "u", "<p>" + "word " * 60_000)]
    got = main_texts(frame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.url): r for r in got}
    for i, u, p in rows[:30]:
        assert by[i, u].text == truth(p) and by[i, u].n_chars == len(truth(p))
    assert by[100, None].text == "" and by[101, "u"].n_chars == 0 and by[3, "again"].text == truth(pages[3])
    assert main_texts(frame([], "page_id long, url string, html string")).count() == 0


def test_pages_that_use_the_markers_name(frame):
    from farelane.llm.dom import parse

    for value in ("x", "", "1", "js/app", "0"):
        page = parse(f'<article data-main="{value}"><p>text</p></article>')
        assert set(page.main) == {-1} and "text" in page.text


def test_hostile_quotes_take_linear_time():
    import time

    from farelane.llm.dom import parse

    began = time.perf_counter()
    for source in ('<a "' * 250_000, "<a '" * 250_000, '<a "\'' * 200_000, '<p title="' + "x" * 1_000_000, '<a ""' * 200_000 + ">", "<" * 1_000_000, '<a "<b ""' * 100_000, "<b>" * 60_000 + "<p>x</p>" * 60_000, "<!" * 300_000, "<div>" * 60_000 + "</p>" * 60_000):
        parse(source)
    assert time.perf_counter() - began < 30


def test_quoted_values_may_hold_markup():
    from farelane.llm.dom import parse

    for source in ('<div title="a > b" class="x"><p>text</p></div>', "<div onclick='f(\"<b>\")'><p>text</p></div>", '<div data-x="<p>no</p>"><p>text</p></div>'):
        assert [t for t in parse(source).text if t] == ["text"]
