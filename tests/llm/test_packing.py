import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers_llm import awkward_rows, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from txnmart.llm import packing

PATH = packing.default_tokenizer()
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = packing.WordEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_words_encode_as_whole_texts(texts):
    got = [list(i) for i in ENCODER.encode([t.encode() for t in texts])]
    assert got == [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|startoftext|>b it's", "İSTANBUL Σίσυφος ñ", "a\x0bb\x85c d"])
def test_odd_words(text):
    assert list(next(ENCODER.encode([text.encode()]))) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_cache_can_be_emptied(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    own = packing.WordEncoder(PATH)
    for text in ("a b c d e", "f g", "a z 123 x-y"):
        assert list(next(own.encode([text.encode()]))) == TOKENIZER.encode(text, add_special_tokens=False).ids


def check(pieces, length, expected):
    """Pieces cover every document once, and sequences have no gap and little padding."""
    of, sequences = defaultdict(list), defaultdict(list)
    for doc, start, ids, total, sequence, offset in pieces:
        of[doc].append((start, ids, total))
        sequences[sequence].append((offset, len(ids)))
    assert of.keys() == expected.keys()
    for doc, parts in of.items():
        parts.sort(key=lambda p: p[0])
        assert [p[0] for p in parts] == list(np.cumsum([0] + [len(p[1]) for p in parts])[:-1])
        assert np.concatenate([p[1] for p in parts]).tolist() == expected[doc]
        assert {p[2] for p in parts} == {len(expected[doc])}
    padding = 0
    for parts in sequences.values():
        parts.sort()
        at = 0
        for offset, n in parts:
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


@pytest.mark.parametrize("most_open", [2, 4096])
def test_level_packer(most_open):
    rng = random.Random(0)
    packer, expected = packing.LevelPacker(64, most_open), {}
    for doc in range(500):
        ids = [rng.randrange(1000) for _ in range(rng.choice([1, 5, 63, 64, 65, rng.randint(1, 300)]))]
        expected[doc] = ids
        packer.put(doc, np.array(ids, np.uint32))
    packer.close()
    assert check(packer.closed(), 64, expected) == 0


def test_level_choice_is_the_smallest_sum_of_squares():
    rng = np.random.default_rng(1)
    for _ in range(200):
        packer = packing.LevelPacker(12)
        packer.count[1:12] = rng.integers(0, 4, 11)
        size = int(rng.integers(1, 12))

        def after(level, packer=packer, size=size):
            c = packer.count.copy()
            if level:
                c[level] -= 1
            if level + size < 12:
                c[level + size] += 1
            return (c[1:12] ** 2).sum()

        options = [0] + [h for h in range(1, 13 - size) if packer.count[h]]
        best = min(after(h) for h in options)
        assert packer._level(size) == max(h for h in options if after(h) == best)


def test_pack_awkward_rows(spark):
    rows = awkward_rows()
    docs = documents(spark, [(i, *r[1:]) for i, r in enumerate(rows)], extra=True)
    expected = {
        i: [*TOKENIZER.encode(r[1] or "", add_special_tokens=False).ids, packing.END_ID] for i, r in enumerate(rows)
    }
    pieces = packing.pack(docs, PATH).collect()
    got = [
        (p["doc_id"], p["start"], np.frombuffer(p["ids"], "<u4"), p["doc_tokens"], p["sequence_id"], p["offset"])
        for p in pieces
    ]
    assert check(got, packing.LENGTH, expected) == 0
    report = packing.piece_report(packing.pack(docs, PATH)).collect()
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in report} == {
        (d, s): zlib.crc32(i.tobytes()) for d, s, i, *_ in got
    }


def test_pack_nothing(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0
