import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from farelane.llm.packing import Encoder, curve_keys, default_vocabulary, hilbert_keys, pack


def test_pieces_against_the_tokenizer(frame):
    rng = random.Random(2)
    tokenizer = Tokenizer.from_file(default_vocabulary())
    words = ["the", "naïve", "x1", "don't", "ÉTÉ", "a b", "…", "12.5", "<|endoftext|>", "日本語"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", "\t", " \n"]) for _ in range(rng.randint(0, 900))) for _ in range(40)]
    texts += [None, "", " ", "\n", "a", "a b\nc d", "word " * 5000]
    rows = list(enumerate(texts)) + [(3, "same id"), (None, "no id")]
    pieces = [tuple(r) for r in pack(frame(rows, "doc_id long, text string"), size=64).collect()]
    want = sorted(str((i, len(ids := tokenizer.encode(t or "", add_special_tokens=False).ids + [0]), zlib.crc32(np.array(ids, "<u4").tobytes()))) for i, t in rows)
    by_sequence, by_doc = {}, {}
    for doc, start, length, crc, total, sequence, offset in pieces:
        by_sequence.setdefault(sequence, []).append((offset, length))
        by_doc.setdefault((doc, total), []).append((sequence * 64 + offset, start, length, crc))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or s == len(by_sequence) - 1
    told = []
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        runs, mine = by_doc[i, len(ids)], []
        for place, start, length, crc in sorted(runs):
            if crc == zlib.crc32(ids[start : start + length].tobytes()):
                mine.append((start, length))
        covered = sorted(mine)
        assert covered[0][0] == 0 and sum(n for _, n in covered) >= len(ids)
        told.append(str((i, len(ids), zlib.crc32(ids.tobytes()))))
    assert sorted(told) == want
    assert sum(p[2] for p in pieces) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)


def test_cached_encoding_equals_the_tokenizer():
    rng = random.Random(9)
    encode, tokenizer = Encoder(default_vocabulary()), Tokenizer.from_file(default_vocabulary())
    alphabet = "ab'sE1.,!é中 \n \n\t \x1c_"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)] + ["x<|endoftext|>y z"]
    for text, raw in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(raw, encode.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_hilbert_curve_visits_neighbours():
    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = hilbert_keys(points, bits=3)
    assert sorted(keys) == list(range(512))
    along = points[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_close_documents_have_close_keys():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50_000, 300).astype(np.uint16) for _ in range(200)]
    near = [np.concatenate([d[:298], d[:2]]) for d in docs]
    keys = curve_keys(docs + near)
    order = np.argsort(np.argsort(keys))
    gaps = np.abs(order[:200] - order[200:])
    assert np.median(gaps) <= 10
    assert curve_keys([docs[0], docs[0][::-1]])[0] == curve_keys([docs[0]])[0]


def test_empty_table(frame):
    assert pack(frame([], "doc_id long, text string")).count() == 0


def test_work_arrays_stay_small_beside_the_texts():
    import tracemalloc

    encode = Encoder(default_vocabulary())
    texts = [" ".join(f"w{(k * 7 + j) % 500}" for j in range(1_000)) for k in range(1_000)]
    encode.arrays(texts[:10])
    tracemalloc.start()
    ids = encode.arrays(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids) == 1_000 and peak < 150_000_000
