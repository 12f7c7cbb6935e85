"""Operator 7: format-preserving pseudonyms for personal data.

Candidates are found by pattern and validated (check digits, ranges, the calendar). The free positions of a
valid value, a number in mixed radices, go through a keyed Feistel permutation of exactly that domain; fixed
parts and punctuation stay and check digits are made anew. Values outside a valid range are permuted
again until they are inside (cycle walking). Zero-padding of slashed and dotted dates may change. So a pseudonym has the format of its value, equal values
of a kind get equal pseudonyms in all documents, different ones stay different, and ``reveal`` undoes it with the key.

Kinds: payment cards (Luhn), IBANs (mod 97), US social security numbers, phone numbers, dates (by calendar day, so that one
day stays linked across notations), IPv4 addresses, e-mail names, and access keys, tokens and passwords.

Defined cases: a null text stays null with no replacements; values that fail validation stay; of a run of digits that is no
card the longest part up to a blank or hyphen that is one counts (its pseudonym may differ from the one it has alone where that
would make a card with the digits after it); the earliest match wins, and
of matches at one place the order of ``PATTERNS``; each row is treated by itself. Other columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame

ROUNDS = 8
CACHED_VALUES = 100_000
Batches = Iterator[pa.RecordBatch]

# The notations that are recognised.
PATTERNS = {
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?:ghp_|gho_|sk-)[A-Za-z0-9]{20,}",
    "secret": r"(?i:(?<=token)|(?<=password)|(?<=passwd)|(?<=secret)|(?<=api_key)|(?<=apikey))\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_+/-]{8,}",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)"
             r"|(?<![\w(+-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?!\d)",
}
ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
SEED = re.compile(r"[0-9@]|AKIA|ASIA|gh[po]_|sk-")  # no match is without one of these
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # 1900 to 2099
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = "0123456789abcdef"


class Feistel:
    """Keyed permutations of mixed-radix numbers."""

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def _shift(self, kind: str, radices: tuple[int, ...], turn: int, half: int) -> int:
        told = f"{kind}|{radices}|{turn}|{half}".encode()
        return int.from_bytes(hashlib.shake_256(self.key + told).digest(32 + len(radices)), "big")

    def permute(self, kind: str, digits: list[int], radices: tuple[int, ...], back: bool = False) -> list[int]:
        """The permuted digits; ``back`` undoes it."""
        middle = len(digits) // 2
        if not middle:  # a single position is rotated
            turn = self._shift(kind, radices, 0, 0)
            return [(d + (-turn if back else turn)) % r for d, r in zip(digits, radices, strict=True)]
        halves, sizes = [], []
        for part, base in ((digits[:middle], radices[:middle]), (digits[middle:], radices[middle:])):
            value = 0
            for d, r in zip(part, base, strict=True):
                value = value * r + d
            halves.append(value)
            sizes.append(prod(base))
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            at = turn % 2
            shift = self._shift(kind, radices, turn, halves[1 - at])
            halves[at] = (halves[at] + (-shift if back else shift)) % sizes[at]
        out: list[int] = []
        for value, base in zip(halves, (radices[:middle], radices[middle:]), strict=True):
            part = []
            for r in reversed(base):
                value, d = divmod(value, r)
                part.append(d)
            out += reversed(part)
        return out

    def walk(self, kind: str, digits: list[int], radices: tuple[int, ...], valid: Callable[[list[int]], bool], back: bool = False) -> list[int]:
        """Permute until the digits are valid again."""
        digits = self.permute(kind, digits, radices, back)
        while not valid(digits):
            digits = self.permute(kind, digits, radices, back)
        return digits


def luhn_digit(payload: list[int]) -> int:
    """The check digit of a card number without it."""
    total = 0
    for i, d in enumerate(reversed(payload)):
        d = d * 2 if i % 2 == 0 else d
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, account: str) -> str:
    """The two check digits of an IBAN."""
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c in CLASSES[0]]


def _refill(shape: str, digits: list[int]) -> str:
    left = iter(digits)
    return "".join(str(next(left)) if c in CLASSES[0] else c for c in shape)


def _spelled(f: Feistel, kind: str, text: str, back: bool) -> str:
    """Letters and digits permuted within their classes (hexadecimal secrets within theirs), the rest as it is."""
    mixed = lambda d: any(x < 10 for x in d) and any(x >= 10 for x in d)
    is_hex = kind == "secret" and len(text) >= 16 and all(c in HEX for c in text) and mixed([HEX.index(c) for c in text])
    places = [(i, a) for i, c in enumerate(text) for a in ((HEX,) if is_hex else CLASSES) if c in a]
    if not places:
        return text
    digits, radices = [a.index(text[i]) for i, a in places], tuple(len(a) for _, a in places)
    new = f.walk(kind, digits, radices, mixed if is_hex else lambda d: True, back)
    out = list(text)
    for (i, a), d in zip(places, new, strict=True):
        out[i] = a[d]
    return "".join(out)


def _is_card(d: list[int]) -> bool:
    return 13 <= len(d) <= 19 and luhn_digit(d[:-1]) == d[-1] and len(set(d)) > 1


def _parts(run: str) -> Iterator[tuple[str, str]]:
    """A run of digits cut at its blanks or hyphens, longest first: the part before and what follows."""
    for i in range(len(run) - 1, 0, -1):
        if run[i] not in CLASSES[0] and len(_digits(run[:i])) >= 13:
            yield run[:i], run[i:]


def _card(f: Feistel, text: str, back: bool, after: str = "") -> str | None:
    """``after`` are the digits that follow in the run; a pseudonym makes no card with them, as its value does not."""
    d = _digits(text)
    if not _is_card(d):
        return None
    more = [_digits(after[:i]) for i in range(2, len(after) + 1) if i == len(after) or after[i] not in CLASSES[0]]

    def valid(x: list[int]) -> bool:
        card = [d[0], *x, luhn_digit([d[0], *x])]
        return _is_card(card) and not any(_is_card(card + m) for m in more)

    inner = f.walk("card", d[1:-1], (10,) * (len(d) - 2), valid, back)
    return _refill(text, [d[0], *inner, luhn_digit([d[0], *inner])])


def _iban(f: Feistel, text: str, back: bool) -> str | None:
    plain = text.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or iban_check(country, account) != check:
        return None
    account = _spelled(f, "iban" + country, account, back)
    left = iter(country + iban_check(country, account) + account)
    return "".join(c if c == " " else next(left) for c in text)


def _ssn_valid(d: list[int]) -> bool:
    area = d[0] * 100 + d[1] * 10 + d[2]
    return area not in (0, 666) and area < 900 and any(d[3:5]) and any(d[5:])


def _ssn(f: Feistel, text: str, back: bool) -> str | None:
    d = _digits(text)
    return _refill(text, f.walk("ssn", d, (10,) * 9, _ssn_valid, back)) if _ssn_valid(d) else None


def _phone(f: Feistel, text: str, back: bool) -> str | None:
    d = _digits(text)
    american = not text.startswith("+") or (d[0] == 1 and len(d) == 11)
    head, rest = (d[:-10], d[-10:]) if american else (d[:2], d[2:])
    valid = (lambda x: x[0] >= 2 and x[3] >= 2) if american else (lambda x: x[0] > 0)
    if not (8 <= len(d) <= 15) or len(rest) < 5 or (american and len(head) > 1) or not valid(rest):
        return None
    kind = "phone" if american else "phone" + "".join(map(str, head))
    return _refill(text, head + f.walk(kind, rest, (10,) * len(rest), valid, back))


def _date(f: Feistel, text: str, back: bool) -> str | None:
    a, b, c = (int(x) for x in re.split(r"[-./]", text))
    tries = {"-": [(a, b, c)], ".": [(c, b, a)], "/": [(c, a, b), (c, b, a)]}[re.search(r"[-./]", text)[0]]
    for turn, (y, m, d) in enumerate(tries):
        try:
            day = datetime.date(y, m, d).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            return None
        bits = [day >> 9, day & 511]
        high, low = f.walk("date", bits, (256, 512), lambda x: x[0] * 512 + x[1] < DAYS, back)
        new = datetime.date.fromordinal(FIRST_DAY + high * 512 + low)
        if "-" in text:
            return new.isoformat()
        first, second = (new.day, new.month) if "." in text or turn else (new.month, new.day)
        if "/" in text and turn and new.day <= 12:  # it would be read month first
            first, second = new.month, new.day
        mark = "." if "." in text else "/"
        padded = len(text) == 10
        return f"{first:02d}{mark}{second:02d}{mark}{new.year}" if padded else f"{first}{mark}{second}{mark}{new.year}"
    return None


def _ip(f: Feistel, text: str, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    valid = lambda x: 0 < x[0] < 224
    d = [int(p) for p in parts]
    return ".".join(map(str, f.walk("ip", d, (256,) * 4, valid, back))) if valid(d) else None


def _email(f: Feistel, text: str, back: bool) -> str | None:
    name, _, domain = text.rpartition("@")
    return f"{_spelled(f, 'email', name, back)}@{domain}"


def _key(f: Feistel, text: str, back: bool) -> str | None:
    head = re.match(r"AKIA|ASIA|ghp_|gho_|sk-", text)[0]
    return head + _spelled(f, "key" + head, text[len(head):], back)


def _secret(f: Feistel, text: str, back: bool) -> str | None:
    head = re.match(r"\s*[=:]\s*[\"']?", text)[0]
    value = text[len(head):]
    return head + _spelled(f, "secret", value, back) if any(c in CLASSES[0] for c in value) else None


CHANGES = {
    "key": _key, "secret": _secret, "email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
}


class Pseudonyms:
    """Replaces the personal data of texts; values met before are remembered."""

    def __init__(self, key: str, back: bool = False):
        self.feistel, self.back, self.known = Feistel(key), back, {}

    def _change(self, kind: str, value: str) -> str | None:
        if (kind, value) not in self.known:
            if len(self.known) >= CACHED_VALUES:
                self.known.clear()
            self.known[kind, value] = CHANGES[kind](self.feistel, value, self.back)
        return self.known[kind, value]

    def _leading_card(self, text: str, start: int) -> tuple[str, int] | None:
        """The pseudonym of a card that further digits follow, and where the card ends."""
        run = COMPILED["card"].match(text, start)
        for part, after in _parts(run[0]) if run else ():
            if (new := _card(self.feistel, part, self.back, after)) is not None:
                return new, start + len(part)
        return None

    def __call__(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        counts: dict[str, int] = {}
        if not SEED.search(text):
            return text, counts
        out, at, pos = [], 0, 0
        while match := ANY.search(text, pos):
            new, end = self._change(match.lastgroup, match[0]), match.end()
            if new is None:  # perhaps another kind fits at this place
                for kind, pattern in COMPILED.items():
                    other = pattern.match(text, match.start())
                    if kind != match.lastgroup and other and (new := self._change(kind, other[0])) is not None:
                        end = other.end()
                        break
                else:
                    if (found := self._leading_card(text, match.start())) is None:
                        pos = match.start() + 1
                        continue
                    kind, (new, end) = "card", found
            else:
                kind = match.lastgroup
            out += [text[at : match.start()], new]
            counts[kind] = counts.get(kind, 0) + 1
            at = pos = end
        out.append(text[at:])
        return "".join(out), counts


COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}


def pseudonymised(documents: DataFrame, key: str, back: bool = False) -> DataFrame:
    """``doc_id, text`` with pseudonyms, ``n_replaced`` and ``kinds`` (kind to count) of every row."""

    def run(batches: Batches) -> Batches:
        replace = Pseudonyms(key, back)
        for batch in batches:
            done = [(None, {}) if t is None else replace(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text": pa.array([t for t, _ in done], pa.string()),
                "n_replaced": pa.array([sum(c.values()) for _, c in done], pa.int64()),
                "kinds": pa.array([sorted(c.items()) for _, c in done], pa.map_(pa.string(), pa.int64())),
            })

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text string, n_replaced long, kinds map<string,bigint>")


def reveal(documents: DataFrame, key: str) -> DataFrame:
    """Undoes ``pseudonymised`` with its key."""
    return pseudonymised(documents, key, back=True)
