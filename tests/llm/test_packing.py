import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barlens.llm.packing import TextIds, pack_documents, piece_lengths, plan_best_fit
from barlens.llm.queries import tokenizer_path

from .conftest import odd_documents


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from([*" \n\t'sa1.é日\xa0\x1c!<|>", "<|endoftext|>", "don't", "  "])).map("".join)
)
def test_ids_are_the_tokenizers(text):
    ids = np.frombuffer(ids_once()(text), "<u4").tolist()
    assert ids == tokenizer_once().encode(text, add_special_tokens=False).ids


_once = {}


def ids_once():
    return _once.setdefault("ids", TextIds(tokenizer_path()))


def tokenizer_once():
    return _once.setdefault("tokenizer", Tokenizer.from_file(tokenizer_path()))


def best_fit_bins(lengths, capacity):
    """Best fit decreasing, item by item."""
    spaces = []
    for length in sorted(lengths, reverse=True):
        fitting = [s for s in spaces if s >= length]
        if fitting:
            spaces.remove(min(fitting))
            spaces.append(min(fitting) - length)
        else:
            spaces.append(capacity - length)
    return len(spaces)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_equals_best_fit_of_single_pieces(lengths):
    histogram = defaultdict(int)
    for n in lengths:
        histogram[n] += 1
    runs = plan_best_fit(histogram, 40)
    placed = [(seq + i, off, n) for n, _, count, seq, off in runs for i in range(count)]
    assert sorted(n for _, _, n in placed) == sorted(lengths)
    sequences = defaultdict(list)
    for seq, off, n in placed:
        sequences[seq].append((off, n))
    for slots in sequences.values():
        at = 0
        for off, n in sorted(slots):
            assert off == at
            at += n
        assert at <= 40
    assert len(sequences) == best_fit_bins(lengths, 40)


def test_first_piece_takes_the_rest():
    assert piece_lengths(5, 4) == [1, 4]
    assert piece_lengths(8, 4) == [4, 4]
    assert piece_lengths(4, 4) == [4]


def test_pieces_and_slots(spark, documents, tokenizer):
    rows = odd_documents(null_ids=True)
    docs = documents(rows).withColumnRenamed("lang", "piece").repartition(5)
    packed = pack_documents(docs, tokenizer_path(), capacity=64, keep_ids=True).collect()
    expected = []
    for doc, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        start = 0
        for piece, n in enumerate(piece_lengths(len(ids), 64)):
            part = np.array(ids[start : start + n], "<u4").tobytes()
            expected.append((doc, piece, start, n, zlib.crc32(part), part))
            start += n
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in packed]
    order = lambda r: (r[0] is not None, r[0] or 0, r[5], r[1])
    assert sorted(got, key=order) == sorted(expected, key=order)
    ends = defaultdict(list)
    for r in packed:
        ends[r.sequence_id].append((r.offset, r.length))
    for slots in ends.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 64
    assert len(ends) == best_fit_bins([r.length for r in packed], 64)


def test_many_pieces_of_one_length(spark, documents):
    rows = [(i, "one", None, None, None) for i in range(5000)]
    random.Random(1).shuffle(rows)
    packed = pack_documents(documents(rows).repartition(8), tokenizer_path(), capacity=10)
    assert packed.select("sequence_id").distinct().count() == 1000
    assert packed.select("sequence_id", "offset").distinct().count() == 5000
