from __future__ import annotations

import re
import time
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from concord.llm import tandem_runs


def brute(w, least):
    """All runs, by every period and every start."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and w:
        h = crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def brute_row(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w, 12)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha256(listed.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=50), st.integers(1, 9), st.integers(0, 40), st.sampled_from([2, 5, 12]))
def test_runs_of_any_sequence(symbols, period, times, least):
    symbols = symbols + (symbols[-period:] * times)[: 60 - len(symbols)]
    wanted = [r for r in brute(symbols, 2) if r[1] >= least]
    assert [tuple(r) for r in tandem_runs.runs_of(symbols, least).tolist()] == wanted


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("symbols", [[], [1], [1] * 40, fibonacci(144), list(range(30)) * 2, [1, 2] * 20 + [3] + [1, 2] * 20, [0, 0, 1] * 9 + [0, 0, 0]])
def test_runs_of_known_sequences(symbols):
    for least in (2, 12):
        assert [tuple(r) for r in tandem_runs.runs_of(symbols, least).tolist()] == [r for r in brute(symbols, 2) if r[1] >= least]


def test_stretches_hold_every_run():
    rng = np.random.default_rng(1)
    noise = rng.integers(10, 10**9, size=500)
    symbols = np.concatenate([noise[:200], np.tile(noise[:7], 5), noise[200:400], np.tile(noise[300:330], 2), noise[400:]])
    assert [tuple(r) for r in tandem_runs.runs_of(symbols).tolist()] == brute(symbols.tolist(), 12)
    assert sum(b - a for a, b in tandem_runs.stretches(symbols, 6)) < 200


def test_long_texts_take_seconds():
    for symbols in (np.zeros(150_000), np.arange(150_000) % 50_000, np.array(fibonacci(50_000))):
        began = time.perf_counter()
        assert len(tandem_runs.runs_of(symbols.astype(np.int64))) >= 1
        assert time.perf_counter() - began < 30


def test_query_against_brute_force(spark, sf_dir, documents):
    wanted = sorted(brute_row(r["doc_id"], r["text"]) for r in documents.collect() if len((r["text"] or "").split()) < 400)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = {r["doc_id"]: tuple(r[c] for c in names) for r in tandem_runs.op12_gusfield_stoye_runs(spark, sf_dir).collect()}
    assert len(found) == documents.count() and len(wanted) > 100
    assert [found[w[0]] for w in wanted] == wanted
    assert sum(w[1] > 0 for w in wanted) > 5


def test_odd_documents(spark, odd_documents, no_documents):
    rows = tandem_runs.find_runs(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by_id[7]["runs"]] == [(0, 12, 1)] and by_id[7]["collapsed"] == "tie"
    assert [tuple(x) for x in by_id[5]["runs"]] == [(0, 30_000, 1)] and by_id[5]["collapsed"] == "wörd"
    assert by_id[4]["runs"] == by_id[6]["runs"] == [] and by_id[4]["collapsed"] == by_id[6]["collapsed"] == ""
    assert by_id[None]["runs"] == []
    assert tandem_runs.find_runs(no_documents).count() == 0
    planted_rows = tandem_runs.with_planted_runs(odd_documents).collect()
    for r, o in zip(planted_rows, odd_documents.collect(), strict=True):
        assert (r["text"] or "").split() == planted(o["doc_id"], o["text"])


def test_a_run_that_repeats_another_way(spark):
    """Other columns and a smaller least length."""
    df = spark.createDataFrame([("k", "x a b a b a b y")], "id string, body string")
    r = tandem_runs.find_runs(df, least=6, id_col="id", text_col="body").first()
    assert (r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) == ("k", [(1, 6, 2)], "x a b y")
