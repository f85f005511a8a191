from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from concord.llm import sharding


def brute_capacity(sizes, shards):
    n = len(sizes)
    best = None
    for cuts in itertools.combinations_with_replacement(range(n + 1), shards - 1):
        ends = [0, *cuts, n]
        worst = max(sum(sizes[a:b]) for a, b in itertools.pairwise(ends))
        best = worst if best is None else min(best, worst)
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(1, 4))
def test_capacity_is_minimal_and_kept(sizes, shards):
    sizes = np.array(sizes, dtype=np.int64)
    capacity = brute_capacity(sizes.tolist(), shards)
    assert sharding.smallest_capacity(sizes, shards) == capacity
    ends = sharding.cut_points(sizes, shards)
    assert ends[-1] == len(sizes) and ends == sorted(ends) and len(ends) == shards
    assert max(int(sizes[a:b].sum()) for a, b in itertools.pairwise([0, *ends])) <= capacity


def test_a_giant_group_has_a_shard_of_its_own():
    sizes = np.array([5, 500, 5, 5, 5, 5, 5, 5], dtype=np.int64)
    shard = sharding.assign_bins(sizes, 4)
    assert (shard == shard[1]).sum() == 1
    rest = [int(sizes[(shard == k)].sum()) for k in range(4) if k != shard[1]]
    assert max(rest) - min(rest) <= 5


def check(rows, texts, shards):
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r["doc_id"]] or "", set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


def test_documents(spark, sf_dir, documents):
    rows = sharding.op1_minimax_sharding(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(rows) == len(texts)
    check(rows, texts, 40)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)


def test_shards_are_near_equal(documents):
    sizes = {r["shard"]: r["b"] for r in sharding.shard_documents(documents, 5).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "b").collect()}
    assert len(sizes) == 5 and max(sizes.values()) < 1.15 * min(sizes.values())


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_odd_documents(odd_documents, shards):
    rows = sharding.shard_documents(odd_documents, shards).collect()
    assert len(rows) == odd_documents.count()
    check(rows, {r["doc_id"]: r["text"] for r in odd_documents.collect()}, shards)


def test_no_documents(no_documents):
    assert sharding.shard_documents(no_documents, 4).collect() == []
