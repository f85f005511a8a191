from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import duckdb
import pytest

from concord.llm import importance_draw

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest=1, buckets=10_000):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % buckets for r in runs]


def brute(docs, target, longest=1, percent=10, least_words=20, seed=2024):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows, one after the other."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text, longest)[1])
    for text in target:
        t.update(features(text, longest)[1])
    every, wanted = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (every + 10_000) / ((s[b] + 1) * (wanted + 10_000))))
    rows, eligible = [], []
    for doc, text in docs:
        n_words, f = features(text, longest)
        weight = sum(map(gain, f)) // len(f) if f else 0
        score = None
        if doc is not None:
            h = int(sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n_words >= least_words:
                eligible.append((-score, doc, len(f), weight, len(rows)))
        rows.append([doc, len(f), weight, score, None])
    for rank, (*_, at) in enumerate(sorted(eligible)[: percent * len(eligible) // 100], 1):
        rows[at][4] = rank
    return sorted(map(tuple, rows), key=repr)


def collected(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, folder):
    read = lambda name, columns: duckdb.sql(f"SELECT {columns} FROM '{folder}/{name}.parquet'").fetchall()
    found = collected(importance_draw.op13_crc_ring_resampling(spark, folder))
    assert found == brute(read("documents", "doc_id, text"), [t for (t,) in read("benchmark", "text")])
    assert sum(rank is not None for *_, rank in found) > 10 and len({w for _, _, w, *_ in found}) > 20


def test_ring_gives_every_run_of_words():
    words = importance_draw.words_of("The 1st -- Über　word,a_b")
    assert words == [w.encode() for w in ("the", "1st", "Über　word", "a", "b")]
    for longest in (1, 2, 3, 9):
        wanted = Counter(crc32(b" ".join(words[i : i + n])) for n in range(1, longest + 1) for i in range(len(words) - n + 1))
        assert Counter(importance_draw.ring(words, longest)) == wanted
    assert list(importance_draw.ring([], 3)) == []


def test_longer_features_other_shares_and_seeds(spark):
    docs = [(i, " ".join(f"w{(i * j) % 7}" for j in range(i))) for i in range(60)]
    target = ["w1 w2 w3 w1 w2", "w5", None]
    df, t = spark.createDataFrame([(f"{i}", x) for i, x in docs], "id string, body string"), spark.createDataFrame([(x,) for x in target], "body string")
    found = importance_draw.resample(df, t, percent=33, least_words=5, longest=3, seed=7, id_col="id", text_col="body")
    assert collected(found.withColumn("doc_id", found["doc_id"].cast("long"))) == brute(docs, target, 3, 33, 5, 7)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    target = odd_documents.limit(2)
    found = importance_draw.resample(odd_documents, target, percent=100, least_words=12)
    assert collected(found) == brute(rows, [r["text"] for r in target.collect()], 1, 100, 12)
    assert importance_draw.resample(no_documents, target).count() == 0
    bare = importance_draw.resample(odd_documents, no_documents)
    assert collected(bare) == brute(rows, [])
