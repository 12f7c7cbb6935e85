"""A small tolerant page parser and node features, as help inside tasks of the HTML extraction."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

# Fixed values of HTML: elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg iframe head object canvas math textarea select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike "
    "strong sub sup time tt u var wbr br img".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SCOPES = frozenset("ul ol dl table body html div section article main aside nav footer header form td th".split())
# What a tag holds up to its end, and the few quoted values in it that hold a "<" themselves: bounded, so that a quote left open
# never makes the rest of the page part of a tag.
PLAIN = r"(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+"
QUOTED_MARKUP = r"(?:\"[^\"]{0,1000}+\"|'[^']{0,1000}+')"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*)(?P<rest>" + PLAIN + "(?:" + QUOTED_MARKUP + PLAIN + r"){0,8}+)>|[^<]+|<", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
REWRITTEN = "<!--rewritten for training-->"
GROUPS = {
    name: i for i, names in enumerate((
        ("article",), ("main",), ("nav", "menu"), ("header", "hgroup"), ("footer",), ("aside",), ("form", "fieldset", "button", "input"),
        ("section", "div", "center"), ("p", "blockquote", "pre"), ("ul", "ol", "dl"), ("li", "dt", "dd"), ("h1", "h2"), ("h3", "h4", "h5", "h6"),
        ("table", "tbody", "thead", "tr", "td", "th"), ("#text",),
    )) for name in names
}
OTHER_GROUP, GROUP_COUNT = 15, 16
NUMBERS = 16


@dataclass
class Page:
    """Nodes in page order, parents first; texts of the ``#text`` nodes."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    tokens: list[frozenset[str]] = field(default_factory=list)  # words of class, id and role
    text: list[str | None] = field(default_factory=list)
    link: list[int] = field(default_factory=list)  # characters inside links
    main: list[int] = field(default_factory=list)  # 1 or 0 where a training page says so, else -1

    def add(self, parent: int, tag: str, tokens: frozenset[str] = frozenset(), main: int = -1) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.text.append(None)
        self.link.append(0)
        self.main.append(main)
        return len(self.tag) - 1


def _attributes(rest: str, marked: bool) -> tuple[frozenset[str], int]:
    tokens, main = [], -1
    for name, a, b, c in ATTRIBUTE.findall(rest):
        value = a or b or c
        if name.lower() == "data-main":
            main = int(value) if marked else -1
            continue
        tokens += [part.lower() for part in PART.findall(value)]
    return frozenset(tokens), main


def parse(source: str) -> Page:
    """The block elements of a page and the runs of text between their boundaries.

    Only a rewritten training page, which begins with ``REWRITTEN``, says by ``data-main`` what is main; given pages use that name
    for ends of their own. Up to eight quoted values of a tag may hold a ``<`` (1,000 characters each), so a quote left open costs no more than that.
    """
    page, marked = Page(), source.startswith(REWRITTEN)
    root = page.add(-1, "body")
    stack: list[tuple[str, int]] = [("body", root)]  # inline elements have no node of their own
    blocks = [root]  # the nodes among them
    opened: Counter[str] = Counter()  # open elements by tag, so that a tag that is not open needs no search
    run: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                at = page.add(blocks[-1], "#text")
                page.text[at], page.link[at] = text, min(links, len(text))
            run.clear()
        links = 0

    def close(to: int) -> None:
        gone = sum(n >= 0 for _, n in stack[to:])
        if gone:
            flush()
            del blocks[-gone:]
        opened.subtract(t for t, _ in stack[to:])
        del stack[to:]

    pos, size = 0, len(source)
    while pos < size:
        match = TOKEN.match(source, pos)
        pos = match.end()
        tag = match["tag"]
        if tag is None:
            if source[match.start()] != "<" or match.end() - match.start() == 1:
                run.append(match[0])
                if opened["a"]:
                    links += len(match[0].strip())
            continue
        tag = tag.lower()
        if match["end"]:
            if opened[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            elif tag not in INLINE:
                flush()
            continue
        if tag in SKIPPED:
            if not match["rest"].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^<>]*>", re.I).search(source, pos)
                body = re.compile(r"<body\b", re.I).search(source, pos) if tag == "head" and not end else None
                pos = end.end() if end else body.start() if body else size  # an unclosed head ends at the body
            continue
        if tag in ("html", "body"):
            continue
        if tag in INLINE:
            if tag == "br":
                run.append(" ")
            if tag not in VOID and not match["rest"].rstrip().endswith("/"):
                stack.append((tag, -1))
                opened[tag] += 1
            continue
        closing = CLOSES.get(tag, ("p",) if tag not in VOID or tag == "hr" else ())
        for i in range(len(stack) - 1, 0, -1) if any(opened[t] > 0 for t in closing) else ():
            if stack[i][0] in closing:
                close(i)
                break
            if stack[i][0] in SCOPES:
                break
        flush()
        if tag not in VOID:
            tokens, main = _attributes(match["rest"], marked) if match["rest"] else (frozenset(), -1)
            blocks.append(page.add(blocks[-1], tag, tokens, main))
            stack.append((tag, blocks[-1]))
            opened[tag] += 1
    flush()
    return page


def bits(masks: list[int], count: int) -> np.ndarray:
    """0 and 1 for each bit of the masks."""
    size = (count + 7) // 8
    raw = np.frombuffer(b"".join(m.to_bytes(size, "little") for m in masks), np.uint8).reshape(-1, size)
    return np.unpackbits(raw, axis=1, bitorder="little")[:, :count]


def node_features(pages: list[Page], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """A row for each node of all pages, and the pages' first rows (with the end).

    ``vocabulary`` gives the attribute tokens that have a column.
    """
    numbers: list[list[float]] = []
    own_tag, above_tag, own_token, above_token = [], [], [], []
    first = [0]
    for page in pages:
        n = len(page.tag)
        chars, link, stops, runs, inner, depth = [0] * n, list(page.link), [0] * n, [0] * n, [0] * n, [0] * n
        children, place = [0] * n, [0] * n
        tags, tokens, own = [0] * n, [0] * n, [0] * n
        for i in range(n):
            p = page.parent[i]
            for token in page.tokens[i]:
                if token in vocabulary:
                    own[i] |= 1 << vocabulary[token]
            if page.text[i] is not None:
                chars[i], runs[i] = len(page.text[i]), 1
                stops[i] = page.text[i].count(".") + page.text[i].count(",")
            if p >= 0:
                depth[i], place[i] = depth[p] + 1, children[p]
                children[p] += 1
                tags[i] = tags[p] | 1 << GROUPS.get(page.tag[p], OTHER_GROUP)
                tokens[i] = tokens[p] | own[p]
        for i in range(n - 1, 0, -1):
            p = page.parent[i]
            chars[p] += chars[i]
            link[p] += link[i]
            stops[p] += stops[i]
            runs[p] += runs[i]
            inner[p] += inner[i] + 1
        total = max(1, chars[0])
        for i in range(n):
            p = max(page.parent[i], 0)
            beside = max(1, children[p] - 1)
            numbers.append([
                depth[i], np.log1p(chars[i]), link[i] / max(1, chars[i]), stops[i] / max(1, chars[i]), chars[i] / max(1, runs[i]),
                chars[i] / (inner[i] + 1), np.log1p(runs[i]), children[i], children[p], place[i] / max(1, children[p]),
                (chars[p] - chars[i]) / beside, chars[i] / max(1, chars[p]), chars[i] / total, link[p] / max(1, chars[p]),
                chars[p] / max(1, runs[p]), i / n,
            ])
            own_tag.append(1 << GROUPS.get(page.tag[i], OTHER_GROUP))
        above_tag += tags
        own_token += own
        above_token += tokens
        first.append(first[-1] + n)
    x = np.hstack([
        np.array(numbers, np.float32).reshape(-1, NUMBERS), bits(own_tag, GROUP_COUNT), bits(above_tag, GROUP_COUNT),
        bits(own_token, len(vocabulary)), bits(above_token, len(vocabulary)),
    ])
    return x, np.array(first)
