"""Operator 11: licence notices and licence expressions in texts.

An Aho-Corasick automaton over the words of a text finds notice phrases and identifier tags in one pass, whatever their number.
Words are put side by side with one blank between them, so a phrase is found where its words stand consecutively, whatever stands
between them in the text. What follows an identifier tag ("SPDX-License-Identifier:", "License-Expression:") is a licence
expression; a shunting-yard parser reads it as far as it is one ("with" binds before "and", "and" before "or").

An expression is worth what a reader may choose: of "or" the less restrictive side, of "and" the more restrictive one, an exception
("with") takes a third off. Phrases are worth their label's restriction. A document's score is its most restrictive notice, from 0
(none, or public domain) to 1 (all rights reserved).

Defined cases: null and empty texts have no words, no labels and score 0; a tag without an expression, or an expression cut off
after an operator or an open bracket, counts as far as it is whole; unknown identifiers get the label "other"; each row gets a row,
whether ids repeat or are null. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from farelane.llm.common import sliced

# The phrases that every scan has, and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Notice phrases beside them.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "bsd license": "bsd", "isc license": "isc", "boost software license": "bsl",
    "creative commons zero": "cc0", "public domain": "public-domain", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by nc": "cc-by-nc",
    "creative commons attribution": "cc-by", "all rights reserved": "proprietary", "the unlicense": "unlicense",
}
# Words of the tags that an expression follows.
TAGS = {"spdx license identifier", "license expression"}
# Identifiers by their beginnings, the longest that fits counts.
IDENTIFIERS = {
    "agpl": "agpl", "apache": "apache", "bsd": "bsd", "0bsd": "bsd", "bsl": "bsl", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd",
    "cc-by-sa": "cc-by-sa", "cc0": "cc0", "epl": "epl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl",
    "unlicense": "unlicense", "licenseref-proprietary": "proprietary",
}
RESTRICTION = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1, "apache": 0.2, "cc-by": 0.2,
    "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "other": 0.5, "cc-by-sa": 0.6, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.8, "proprietary": 1.0,
}
EXCEPTION = 2 / 3
BINDS = {"or": 1, "and": 2, "with": 3}
# Letters and digits are ASCII or not ASCII at all; A-Z become a-z, the rest divides words.
WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
TAG = re.compile(r"(?:spdx[^0-9a-z\x80-\U0010FFFF]+license[^0-9a-z\x80-\U0010FFFF]+identifier|license[^0-9a-z\x80-\U0010FFFF]+expression)[ \t]*[:=]", re.IGNORECASE | re.ASCII)
TOKEN = re.compile(r"[ \t]*(?:([()])|([0-9a-z][0-9a-z.+-]*))", re.IGNORECASE | re.ASCII)
Batches = Iterator[pa.RecordBatch]


class Terms(NamedTuple):
    """What an expression or a part of it says: labels of all licences named, and how restrictive the best choice is."""

    labels: frozenset[str]
    restriction: float


def label_of(identifier: str) -> str:
    """Family of a licence identifier."""
    parts = identifier.rstrip("+").split("-")
    for n in range(len(parts), 0, -1):
        if (label := IDENTIFIERS.get("-".join(parts[:n]))) is not None:
            return label
    return "other"


def _joined(operator: str, left: Terms, right: Terms) -> Terms:
    if operator == "with":
        return Terms(left.labels, left.restriction * EXCEPTION)
    choose = min if operator == "or" else max
    return Terms(left.labels | right.labels, choose(left.restriction, right.restriction))


def evaluate(text: str, at: int = 0) -> Terms | None:
    """The expression that stands at ``at``, as far as it goes; None if there is none."""
    values: list[Terms] = []
    waiting: list[str] = []

    def settle(binds: int) -> None:
        while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= binds:
            right, left = values.pop(), values.pop()
            values.append(_joined(waiting.pop(), left, right))

    opened = 0
    operand = True  # whether an identifier or a bracket comes next
    while (token := TOKEN.match(text, at)) is not None:
        word = (token[1] or token[2]).lower()
        if operand:
            if word == "(":
                waiting.append(word)
                opened += 1
            elif word == ")" or word in BINDS:
                break
            else:
                label = label_of(word.rstrip("."))
                values.append(Terms(frozenset([label]), RESTRICTION[label]))
                operand = False
        elif word == ")":
            if not opened:
                break
            settle(0)
            waiting.pop()
            opened -= 1
        elif word in BINDS:
            settle(BINDS[word])
            waiting.append(word)
            operand = True
        else:
            break
        at = token.end()
    if operand:  # cut off: the last operator has no right side
        while waiting and waiting.pop() == "(":
            pass
    waiting[:] = [w for w in waiting if w != "("]
    settle(0)
    return values[-1] if values else None


def automaton() -> ahocorasick.Automaton:
    """All phrases and tags, each with a blank at both ends, with (words, label or None, whether base)."""
    found = ahocorasick.Automaton()
    for phrases, base in ((MORE_PHRASES, False), (BASE_PHRASES, True)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (phrase, label, base))
    for tag in TAGS:
        found.add_word(f" {tag} ", (tag, None, False))
    found.make_automaton()
    return found


class Scan(NamedTuple):
    """Of one text."""

    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: str
    labels: str
    score: float


def scan(text: str | None, known: ahocorasick.Automaton) -> Scan:
    """Places and labels of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    n_base, first, last, tagged = 0, len(line), -1, False
    base: set[str] = set()
    labels: set[str] = set()
    for end, (phrase, label, is_base) in known.iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        if is_base:
            start = end - len(phrase) - 1
            n_base, first, last = n_base + 1, min(first, start), max(last, start)
            base.add(label)
    score = max((RESTRICTION[x] for x in labels), default=0.0)
    if tagged:
        for tag in TAG.finditer(text):
            if (said := evaluate(text, tag.end())) is not None:
                labels |= said.labels
                score = max(score, said.restriction)
    place = [line.count(" ", 0, at) if n_base else None for at in (first, last)]
    return Scan(len(words), n_base, *place, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def licences(documents: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Batches) -> Batches:
        known = automaton()
        for batch in sliced(batches):
            each = [scan(text, known) for text in batch.column("text").to_pylist()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*each, strict=True), kinds, strict=True)] if each else [pa.array([], k) for k in kinds]
            yield pa.record_batch([batch.column("doc_id"), *columns], ["doc_id", *Scan._fields])

    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
