import random
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from edgetide.llm import simple8b
from edgetide.llm.packing import Windows, pack_documents
from edgetide.llm.tokens import Encoder, default_tokenizer


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(default_tokenizer())

    def encode(text):
        return tokenizer.encode(text, add_special_tokens=False).ids if text else []

    return encode


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("remembered", [10, 250_000])
def test_cut_texts_encode_like_whole_ones(whole, odd_texts, remembered):
    rng = random.Random(5)
    parts = ["the", "don't", "I'll", "a.", "b,c", "##", "x12", "é", "汉", " ", "  ", "\n", "\t",
             "\n\n", "\x1c", " ", "\x85", "!!", "'s", "|", "\x00", ".", "²", "(a)."]
    texts = [rng.choice(["", " ", "\n"]).join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(800)]
    texts += [" ".join(rng.choices(parts, k=6)) for _ in range(400)] + odd_texts
    found = list(Encoder(remembered=remembered)(texts))
    assert found == [packed(whole(text)) for text in texts]


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    cases = [
        [], [0], [0] * 1000, [2**64 - 1], [2**60, 2**60 - 1, 1], [1, 2**63, 0, 2**64 - 1, 5],
        rng.integers(0, 50_257, 9999), rng.integers(0, 2, 777), 2 ** rng.integers(0, 64, 500, np.uint64),
    ]
    for case in cases:
        values = np.array(case, np.uint64)
        words, escapes = simple8b.encode(values)
        assert np.array_equal(simple8b.decode(words, escapes), values)
        assert len(escapes) == (values >= 2**60).sum()


def test_simple8b_packs_as_many_as_fit():
    assert len(simple8b.encode(np.zeros(60, np.uint64))[0]) == 1
    assert len(simple8b.encode(np.full(12, 31, np.uint64))[0]) == 1
    assert len(simple8b.encode(np.full(4, 2**15 - 1, np.uint64))[0]) == 1
    assert len(simple8b.encode(np.full(4, 2**15, np.uint64))[0]) == 2


def test_simple8b_keeps_no_object_for_each_value():
    values = np.random.default_rng(2).integers(0, 50_257, simple8b.BLOCK_IDS)
    simple8b.encode(values)
    tracemalloc.start()
    simple8b.encode(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 55 * len(values)


def test_written_tokens_read_back(make_docs, odd_texts, crowded, whole):
    docs = crowded(make_docs(odd_texts).repartition(3))
    rows = simple8b.round_trip(docs).orderBy("doc_id").collect()
    start = 0
    for i, text in enumerate(odd_texts):
        ids = [*whole(text), 0]
        assert tuple(rows[i]) == (i, start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    assert len(rows) == len(odd_texts)


def test_repeated_and_null_ids_and_no_rows(make_docs):
    docs = make_docs(["b", "a b", None, "a b"], ids=[2, 1, None, 1])
    rows = sorted(simple8b.round_trip(docs).collect(), key=lambda row: row.start)
    assert [row.doc_id for row in rows] == [None, 1, 1, 2]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert simple8b.round_trip(docs.limit(0)).collect() == []


def test_windows_take_the_best_fit_and_emit_the_fullest():
    windows = Windows(10, 2)
    assert windows.put("a", 6) is None and windows.put("b", 7) is None
    assert windows.put("c", 3) == [("b", 7), ("c", 3)]  # full: it fits b best
    assert windows.put("d", 9) is None
    assert windows.put("e", 5) == [("d", 9)]  # none fits: the fullest goes
    assert sorted(x for items in windows.rest() for x, _ in items) == ["a", "e"]


def check_pieces(rows, texts, whole, length):
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append(row)
    for i, text in enumerate(texts):
        ids, at = [*whole(text), 0], 0
        for row in sorted(by_doc[i], key=lambda row: row.start):
            assert row.start == at and row.doc_tokens == len(ids)
            assert row.ids_crc32 == zlib.crc32(packed(ids[at : at + row.length]))
            at += row.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for row in sorted(pieces, key=lambda row: row.offset):
            assert row.offset == at
            at += row.length
        assert at <= length
    return len(by_sequence)


@pytest.mark.parametrize("most,partitions", [(64, 3), (2, 70)])
def test_packed_pieces(make_docs, odd_texts, crowded, whole, most, partitions):
    docs = crowded(make_docs(odd_texts).repartition(partitions))
    rows = pack_documents(docs, most=most).collect()
    sequences = check_pieces(rows, odd_texts, whole, 1024)
    total = sum(row.length for row in rows)
    assert sequences <= -(-total // 1024) + (2 if most == 64 else 8)


def test_packing_repeated_rows_and_no_rows(make_docs, whole):
    docs = make_docs(["a b c"] * 3 + [None], ids=[7, 7, 7, None])
    rows = pack_documents(docs).collect()
    assert len(rows) == 4 and sum(row.length for row in rows) == 3 * 4 + 1
    assert len({row.sequence_id for row in rows}) == 1
    assert pack_documents(docs.limit(0)).collect() == []
