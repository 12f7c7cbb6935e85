"""Operator 10: pack documents along a space-filling curve.

Each document's token counts are hashed into a vector, projected to three dimensions and numbered along a
Hilbert curve. Documents are range-sorted by that key and laid end to end; every 1024 tokens
a new sequence begins. So only the last sequence can need padding, and neighbours on the curve share sequences.

Defined cases: a null text is empty; every document ends with id 0, so an empty one is a piece of one id;
rows are packed one by one, whether ids repeat or are null; other columns are ignored; an empty
table gives no pieces. Documents on the same point of the curve are ordered by id.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import sliced, stored

HASHED = 512  # cells of a document's hashed vector
DIMENSIONS, BITS = 3, 16  # of the curve
CACHED_WORDS = 2_000_000  # about 30 bytes each
PIECE_CHARS = 1_000_000  # texts are hashed together up to this size (work arrays of some 50 bytes a character); a longer one is hashed alone
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
Batches = Iterator[pa.RecordBatch]


def default_vocabulary() -> str:
    """The public byte-level vocabulary that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_rng = np.random.default_rng(10)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD_WHITE = np.zeros(256, bool)  # ASCII white space but blank and line break
_ODD_WHITE[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_START, _BLANK, _BREAK = 0, 0x20, 0x0A  # what stands before a word


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Encoder:
    """Ids of texts, 16 or 32 bits each; words are encoded once and remembered.

    A byte-level vocabulary splits a text before each blank or line break that stands alone between other
    characters. So a word after a blank, a word that begins a line, and a line break each have ids of their own. Texts with any
    other white space, or with an added token's text, go to the tokenizer whole, as do all texts if the vocabulary is of another kind.
    All words of a batch, with what stands before them, are hashed at once and looked up in a sorted
    array of 64-bit hashes, so two words are taken for one with a chance of about 2**-64 a pair.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.blank_first = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank_first[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.line_break = self._ids("\n")
        self.by_words = len(self.line_break) == 1 and all(
            np.array_equal(x, self._ids(t)) for x, t in zip(self._words(["b", "1", ".,"], " "), (" b", " 1", " .,"), strict=True)
        )
        self.up = self.down = np.ones(1, np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.known, self.at, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.held = np.empty(0, self.kind)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _words(self, words: list[str], mark: str) -> list[np.ndarray]:
        """The ids of many words that each follow a blank, or that each begin a line."""
        if mark == " ":
            ids = self._ids(" " + " ".join(words))
            begin = np.flatnonzero(self.blank_first[ids])
        else:
            ids = self._ids("\n".join(words))
            begin = np.append(0, np.flatnonzero(ids == self.line_break[0]) + 1)
        if len(begin) != len(words):
            return [self._ids(mark.strip("\n") + w) for w in words]
        end = np.append(begin[1:] - (mark != " "), len(ids))
        return [ids[a:b] for a, b in zip(begin.tolist(), end.tolist())]

    def _plain(self, texts: list[str], raw: list[bytes]) -> np.ndarray:
        """Which texts have no white space but single blanks and line breaks between other characters, and no added token."""
        fits = np.zeros(len(texts), bool)
        if not self.by_words:
            return fits
        data = np.frombuffer(b"".join(raw), np.uint8)  # every text begins with a blank
        white = (data == _BLANK) | (data == _BREAK)
        bad = _ODD_WHITE[data]
        bad[:-1] |= white[:-1] & white[1:]
        bad = np.concatenate([[0], np.cumsum(bad)])
        ends = np.cumsum([len(r) for r in raw])
        # A trailing one meets the next text's first blank; the very last byte meets nothing.
        fits = bad[ends] == bad[np.append(0, ends[:-1])]
        if len(raw[-1]) > 1:
            fits[-1] &= not white[-1]
        for i, text in enumerate(texts):
            if not text:
                fits[i] = False
            elif fits[i]:
                fits[i] = (text.isascii() or " ".join(text.split()) == text.replace("\n", " ")) and not any(t in text for t in self.added)
        return fits

    def _look_up(self, hashes: np.ndarray, data: bytes, begin: np.ndarray, end: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Places in ``known`` of sorted distinct hashes of the words at ``begin``; new ones are encoded and added."""
        place = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[place] != hashes) if len(self.known) else np.arange(len(hashes))
        if not len(new):
            return place
        if len(self.known) + len(new) > CACHED_WORDS and len(self.known):  # the words at hand are learnt again
            self._forget()
            new = np.arange(len(hashes))
        ids: list[np.ndarray] = [self.held[:0]] * len(new)
        for blank in (True, False):
            some = np.flatnonzero((mark[new] == _BLANK) == blank)
            for k in range(0, len(some), 4096):
                part = some[k : k + 4096]
                words = [data[a + 1 : b].decode() for a, b in zip(begin[new[part]].tolist(), end[new[part]].tolist())]
                for i, found in zip(part.tolist(), self._words(words, " " if blank else "\n"), strict=True):
                    ids[i] = np.append(self.line_break, found) if mark[new[i]] == _BREAK else found
        size = np.array([len(i) for i in ids], np.int64)
        at = len(self.held) + np.cumsum(size) - size
        self.held = np.concatenate([self.held, *ids])
        order = np.argsort(known := np.concatenate([self.known, hashes[new]]), kind="stable")
        self.known, self.at, self.size = known[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]
        return np.searchsorted(self.known, hashes)

    def _by_words(self, raw: list[bytes]) -> list[np.ndarray]:
        """The ids of plain texts, each given with a blank before it."""
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        starts = ends - [len(r) for r in raw]
        begin = np.flatnonzero((data == _BLANK) | (data == _BREAK))
        end = np.append(begin[1:], len(data))
        if len(self.up) < len(data):
            self.up, self.down = _powers(_BASE, len(data)), _powers(_BASE_INVERSE, len(data))
        value = _BYTE[data] * self.up[: len(data)]
        value[starts] = _BYTE[_START] * self.up[starts]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value, out=sums[1:])
        hashes = (sums[end] - sums[begin]) * self.down[begin]
        first_word = np.searchsorted(begin, starts)
        mark = data[begin].copy()
        mark[first_word] = _START
        distinct, example, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = self._look_up(distinct, joined, begin[example], end[example], mark[example])[back]
        size = self.size[place]
        stop = np.cumsum(size)
        ids = self.held[np.repeat(self.at[place] - (stop - size), size) + np.arange(stop[-1])]
        bounds = np.append((stop - size)[first_word], stop[-1])
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = [self.held[:0]] * len(texts)
        at = 0
        while at < len(texts):  # some at a time, so that the work arrays stay small
            raw, to, held = [], at, 0
            while to < len(texts) and (to == at or held + len(texts[to]) <= PIECE_CHARS):
                raw.append(b" " + texts[to].encode())
                held += len(texts[to])
                to += 1
            plain = np.flatnonzero(self._plain(texts[at:to], raw))
            if len(plain):
                for i, ids in zip(plain.tolist(), self._by_words([raw[i] for i in plain]), strict=True):
                    out[at + i] = ids
            for i in set(range(to - at)) - set(plain.tolist()):
                out[at + i] = self._ids(texts[at + i])
            at = to
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.arrays(texts)]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows) with ``bits`` bits in each coordinate."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations from the coarsest cube down
        low = bit - 1
        for i in range(dims):
            inside = (x[i] & bit) == 0
            swap = np.where(inside, (x[0] ^ x[i]) & low, 0)
            x[0] ^= np.where(inside, swap, low)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """Curve places of documents given by their ids."""
    rng = np.random.default_rng(20)
    projection = rng.standard_normal((HASHED, DIMENSIONS))
    projection /= np.linalg.norm(projection, axis=0)
    cell = (np.arange(1 + max((int(d.max()) for d in documents if len(d)), default=0), dtype=np.uint32) * np.uint32(2654435769)) >> np.uint32(32 - 9)
    cells = cell[np.concatenate(documents)] + np.repeat(np.arange(len(documents)) * HASHED, [len(d) for d in documents])
    vectors = np.log1p(np.bincount(cells, minlength=len(documents) * HASHED).astype(np.float32)).reshape(-1, HASHED)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    # Rounding first keeps equal documents on equal points whatever the order of the sums.
    place = np.round(vectors.astype(np.float64) @ projection, 9)
    return hilbert_keys(np.clip((place + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64))


def _tokenise(path: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encode = _encoder(path)
        for batch in sliced(batches):
            arrays = encode.arrays([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch({
                "uid": batch.column("uid"), "doc_id": batch.column("doc_id"),
                "key": pa.array(curve_keys(arrays), pa.int64()),
                "n": pa.array([len(a) + 1 for a in arrays], pa.int64()),
                "ids": pa.array([a.tobytes() for a in arrays], pa.binary()),
            })

    return run


def _starts(batches: Batches) -> Batches:
    total = 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        ends = np.cumsum(n) + total
        yield pa.record_batch({
            "uid": batch.column("uid"), "part": batch.column("part"), "n": batch.column("n"), "at": pa.array(ends - n, pa.int64()),
        })
        total = int(ends[-1]) if len(ends) else total


def _cut(size: int, kind: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            rows: list[tuple] = []
            for doc, raw, begin in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "begin")), strict=True):
                ids = np.append(np.frombuffer(raw, kind), END_ID).astype("<u4")
                cuts = [0, *range(size - begin % size, len(ids), size), len(ids)]
                for a, b in zip(cuts, cuts[1:]):
                    rows.append((doc, a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids), (begin + a) // size, (begin + a) % size))
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return run


def pack(documents: DataFrame, vocabulary: str | None = None, size: int = 1024) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of all documents."""
    path = vocabulary or default_vocabulary()
    rows = documents.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = stored(rows.mapInArrow(_tokenise(path), "uid long, doc_id long, key long, n long, ids binary"), "tokens")
    curve = told.select("uid", "doc_id", "key", "n").repartitionByRange("key", "doc_id", "uid").sortWithinPartitions("key", "doc_id", "uid")
    curve = curve.withColumn("part", F.spark_partition_id())
    local = stored(curve.mapInArrow(_starts, "uid long, part int, n long, at long"), "curve")
    # One row per partition of the range sort.
    sums = sorted((r["part"], r["n"]) for r in local.groupBy("part").agg(F.sum("n").alias("n")).collect())
    begins, total = [], 0
    for part, n in sums:
        begins.append((part, total))
        total += n
    offsets = documents.sparkSession.createDataFrame(begins, "part int, base long")
    begin = local.join(F.broadcast(offsets), "part").select("uid", (F.col("base") + F.col("at")).alias("begin"))
    kind = _encoder(path).kind.str
    return told.select("uid", "doc_id", "ids").join(begin, "uid").mapInArrow(_cut(size, kind), PIECES)
