"""Token ids, Huffman files and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest

from tillroll.llm import huffman, packing
from tillroll.llm.common import table
from tillroll.llm.tokens import default_vocabulary, encoder
from tillroll.session import scratch_path

from .conftest import ODD


def library_ids(text, end):
    return encoder(default_vocabulary()).library.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("size, symbols", [(1, 1), (127, 3), (129, 40), (50_000, 3000), (70_000, 60_000)])
def test_code_round_trip(size, symbols):
    rng = np.random.default_rng(size)
    ids = np.minimum(rng.zipf(1.3, size), symbols) - 1 if symbols < 60_000 else rng.integers(0, symbols, size)
    counts = np.bincount(ids, minlength=symbols)
    bits = huffman.code_lengths(counts)
    assert bits.max() <= huffman.MAX_BITS and (2.0 ** -bits[bits > 0]).sum() <= 1
    payload, checkpoints = huffman.pack_bits(ids, bits, huffman.canonical_codes(bits))
    assert (huffman.unpack_bits(payload, checkpoints, size, huffman.decode_table(bits)) == ids).all()


def test_code_is_best_without_a_limit():
    """Against Huffman's own construction."""
    import heapq
    counts = np.array([5, 9, 12, 13, 16, 45, 1, 1])
    heap, cost = list(map(int, counts)), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (huffman.code_lengths(counts) * counts).sum() == cost


def read_back(spark, docs):
    path = scratch_path(spark, "test-ids")
    huffman.write_ids(docs, path)
    return huffman.read_digests(spark, path).collect()


def test_files_hold_every_document_in_order(spark, odd):
    rows = sorted(read_back(spark, odd), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == len(ODD)
    want = sorted((-1 if i is None else i, crc(library_ids(t, 1)), len(library_ids(t, 1))) for i, t in ODD)
    assert sorted((-1 if r[0] is None else r[0], r["ids_crc32"], r["n_tokens"]) for r in rows) == want
    starts = np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1]
    assert [r["start"] for r in rows] == starts.tolist()


def test_empty_tables(spark, odd):
    assert read_back(spark, odd.limit(0)) == []
    assert packing.pack_documents(odd.limit(0)).collect() == []


def test_packing_of_given_documents(spark, smoke_dir):
    docs = table(spark, smoke_dir, "documents")
    check_packing(packing.pack_documents(docs).collect(), [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])


def test_packing_of_odd_documents(odd):
    check_packing(packing.pack_documents(odd).collect(), ODD)


def check_packing(rows, docs):
    want = []
    for name, text in docs:
        ids = library_ids(text, 0)
        want += [(name, k, at, len(ids[at:at + 2048]), crc(ids[at:at + 2048]))
                 for k, at in enumerate(range(0, len(ids), 2048))]
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:5] for r in rows), key=order) == sorted(want, key=order)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        reach = 0
        for offset, length in sorted(places):
            assert offset == reach
            reach += length
        assert reach <= 2048
    assert len(sequences) == best_fit([r["length"] for r in rows], 2048)


def best_fit(lengths, width):
    """Best-fit decreasing, a piece at a time."""
    import bisect
    rooms, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, x)
        room = rooms.pop(i) if i < len(rooms) else width
        n += room == width
        if room - x:
            bisect.insort(rooms, room - x)
    return n


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_best_fit_by_piece(seed):
    rng = random.Random(seed)
    width = rng.choice([10, 64, 200])
    counts = {x: rng.randint(1, 50) for x in rng.sample(range(1, width + 1), rng.randint(1, width // 2))}
    used, placed = set(), 0
    for length, _, count, per, sequence, offset in packing.plan_slots(counts, width):
        used |= set(range(sequence, sequence + count // per))
        placed += count
        assert offset + per * length <= width
    assert placed == sum(counts.values())
    assert len(used) == best_fit([x for x, n in counts.items() for _ in range(n)], width)
