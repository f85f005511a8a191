from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from concord.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES, LIBRARY = packing.PieceEncoder(PATH, most=50), Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


@pytest.mark.parametrize("text", ["", " ", "Hello, World!  it's\tfine\n", "<|endoftext|> and<|startoftext|>x", "É é é ́a ΑΣ Σας", "a\x1cb \x1d c d", "日本語 テキスト 123 4", "don't've'll"])
def test_piecewise_encoding_is_the_librarys(tokenizer, text):
    known = packing.PieceEncoder(PATH)
    ids, counts = known.encode(pa.array([text, "", text + " \x01x", text]))
    wanted = [ids_of(tokenizer, t)[:-1] for t in (text, "", text + " \x01x", text)]
    assert ids.tolist() == np.concatenate(wanted).tolist() and counts.tolist() == [*map(len, wanted)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t<|endoftext|>\x01\x0b\x1cAbé\u0301Σ's19.,<|>\u3000\u2003日\u200d"), max_size=30), max_size=5))
def test_any_texts(texts):
    ids, counts = PIECES.encode(pa.array(texts, type=pa.string()))
    wanted = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(wanted, []) and counts.tolist() == [*map(len, wanted)]


def test_dictionary_stays_bounded(tokenizer):
    known = packing.PieceEncoder(PATH, most=5)
    for k in range(40):
        text = " ".join(f"word{k}x{i}" for i in range(4))
        assert known.encode(pa.array([text]))[0].tolist() == ids_of(tokenizer, text)[:-1].tolist()
        assert len(known.once) <= 10 and len(known.often) <= 10 and len(known.words) <= 20


def test_the_vocabulary_has_the_steps_stated():
    assert PIECES.merges is not None


def test_join_checksums():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(300)), rng.randbytes(rng.randrange(300))
        assert packing.join_checksums(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=80))
def test_group_packing(lengths):
    placed = packing.pack_group(np.array(lengths), 64, 4, 1.0, 0.01)
    used, covered = {}, {}
    for row, start, length, k, offset in placed:
        assert offset == used.get(k, 0)
        used[k] = offset + length
        assert used[k] <= 64 and length > 0
        covered.setdefault(row, []).append((start, length))
    for row, n in enumerate(lengths):
        at = 0
        for start, length in sorted(covered[row]):
            assert start == at and start % 4 == 0
            at += length
        assert at == n
    assert len(used) * 64 <= sum(lengths) + 64 + 4 * len(placed)


def plain_packing(lengths, capacity, grain, cost):
    """The rule of pack_group with lists: descending documents, each to the cheapest sequence with room, then what is left over the rooms."""
    rooms, costs = [capacity] * -(-sum(lengths) // capacity), [0.0] * -(-sum(lengths) // capacity)
    out = []

    def put(row, start, length, k):
        out.append((row, start, length, k, capacity - rooms[k]))
        rooms[k] -= length
        costs[k] += cost(length)

    late = []
    for row in sorted(range(len(lengths)), key=lambda r: (-lengths[r], r)):
        fits = [k for k in range(len(rooms)) if rooms[k] >= lengths[row]]
        put(row, 0, lengths[row], min(fits, key=lambda k: (costs[k], k))) if fits else late.append(row)
    for row in late:
        start = 0
        while start < lengths[row]:
            left = lengths[row] - start
            fits = [k for k in range(len(rooms)) if rooms[k] >= min(grain, left)]
            if not fits:
                fits = [len(rooms)]
                rooms.append(capacity)
                costs.append(0.0)
            k = min(fits, key=lambda k: (costs[k], k))
            length = left if rooms[k] >= left else rooms[k] - rooms[k] % grain
            put(row, start, length, k)
            start += length
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 63), min_size=1, max_size=40), st.sampled_from([1, 4, 16]))
def test_group_packing_by_plain_lists(lengths, grain):
    assert packing.pack_group(np.array(lengths), 64, grain, 1.0, 0.25) == plain_packing(lengths, 64, grain, lambda n: n + 0.25 * n * n)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(8, 63), min_size=2, max_size=7))
def test_costs_against_every_placement(lengths):
    """Where no document is cut, the dearest sequence costs at most half more than in the best of all placements."""
    cost = lambda n: n + 0.25 * n * n
    placed = packing.pack_group(np.array(lengths), 64, 4, 1.0, 0.25)
    n = -(-sum(lengths) // 64)
    if len(placed) > len(lengths) or max(p[3] for p in placed) >= n:
        return
    best = float("inf")
    for choice in itertools.product(range(n), repeat=len(lengths)):
        loads = [sum(length for length, c in zip(lengths, choice, strict=True) if c == k) for k in range(n)]
        if max(loads) <= 64:
            best = min(best, max(sum(cost(length) for length, c in zip(lengths, choice, strict=True) if c == k) for k in range(n)))
    found = {}
    for _, _, length, k, _ in placed:
        found[k] = found.get(k, 0) + cost(length)
    assert max(found.values()) <= 1.5 * best


def check(rows, texts, tokenizer):
    ids = {i: ids_of(tokenizer, t) for i, t in texts.items()}
    covered, sequences = {}, {}
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] > 0 and zlib.crc32(own.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return covered, {i: len(v) for i, v in ids.items()}, sequences


def test_documents(spark, sf_dir, documents, tokenizer):
    rows = packing.op4_cost_balanced_packing(spark, sf_dir).collect()
    covered, wanted, sequences = check(rows, {r["doc_id"]: r["text"] for r in documents.collect()}, tokenizer)
    assert covered == wanted
    assert len(sequences) * 2048 <= 1.03 * sum(wanted.values()) + 2048


def test_costs_are_balanced(documents):
    """Sequences of a group differ little in cost, though their documents differ much in length."""
    lengths = np.array([1500, 1200, 900, 700, 600, 500, 400, 300, 200, 150, 100, 80, 60, 40, 20, 10] * 6)
    cost = {}
    for _, _, n, k, _ in packing.pack_group(lengths, 2048, 32, packing.LINEAR, packing.QUADRATIC):
        cost[k] = cost.get(k, 0) + n + n * n / 1024
    assert max(cost.values()) < 1.6 * np.mean(list(cost.values()))


def test_odd_documents(odd_documents, no_documents, tokenizer):
    rows = packing.pack_documents(odd_documents, PATH).collect()
    covered, wanted, _ = check(rows, {r["doc_id"]: r["text"] for r in odd_documents.collect()}, tokenizer)
    wanted[2] *= 2  # a repeated row
    assert covered == wanted
    assert [(r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == 4] == [(1, zlib.crc32(b"\x01\0\0\0"))]
    assert packing.pack_documents(no_documents, PATH).collect() == []
