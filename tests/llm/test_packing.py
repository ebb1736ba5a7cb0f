import random
import zlib

import numpy as np
import pytest
from pickwise.llm import packing

from .helpers import documents, odd_rows, prose

pytest.importorskip("public_tokenizers")


def reference_ids(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary_file(None))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def first_fit(sizes, length):
    room = []
    for s in sorted(sizes, reverse=True):
        for i, r in enumerate(room):
            if r >= s:
                room[i] -= s
                break
        else:
            room.append(length - s)
    return sorted(length - r for r in room)


def test_units_are_tokenised_as_whole_texts():
    rng = random.Random(3)
    bits = ["it's", "don't", "été,", "l'œuvre", "$$x", "naïve.", "«mot»", "3.14", "½", "é", "<|endoftext|>", "İs", "Σας", "한국어", "a b",
            "!'s", "'ll", "word", "WORD!!", "x̸", "≮", "\U0001f600", "a<b", "≮", "x's'll", "ab'c", "“q”", "'", "''s", "\x85", " z", "ÀÉ*"]
    import pyarrow as pa
    texts = [" ".join(rng.choice(bits) for _ in range(40)) for _ in range(50)] + ["".join(rng.choice(bits) for _ in range(20)) for _ in range(80)]
    units, hasher = packing.UnitTokens(packing.vocabulary_file(None)), packing.ByteHash(lower=True)
    out = []
    for s, ids, first in packing.token_slices(pa.array(texts), units, hasher):
        out += [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
    assert out == [reference_ids(t) for t in texts]


def test_first_fit_decreasing():
    rng = random.Random(1)
    sizes = [rng.randint(1, 4095) for _ in range(500)]
    bins = packing.first_fit_decreasing(np.array(sizes), 4096)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert sorted(sum(sizes[i] for i in b) for b in bins) == first_fit(sizes, 4096)


def test_pieces_round_trip(spark):
    rows = [(i, prose(i, 3 + i * 7 % 900), "s") for i in range(200)] + [(999, prose(5, 9000), "s")]
    out = packing.pack(documents(spark, rows), with_ids=True, group_tokens=20000).collect()
    texts = {r[0]: r[1] for r in rows}
    by, seqs = {}, {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for i, pieces in by.items():
        pieces.sort(key=lambda r: r.start)
        ids = reference_ids(texts[i])
        assert [x for r in pieces for x in r.ids] == ids
        assert all(r.doc_tokens == len(ids) for r in pieces)
    for pieces in seqs.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert sum(r.length for r in pieces) <= 4096
    assert set(by) == set(texts)


def test_odd_rows(spark):
    rows = odd_rows()
    out = packing.pack(documents(spark, rows, clash=True)).collect()
    assert sum(r.length for r in out) == sum(len(reference_ids(t)) for _, t, _ in rows)
    assert [r.doc_tokens for r in out if r.doc_id == 1] == [1]
    assert packing.pack(documents(spark, [])).collect() == []
