from __future__ import annotations

import re
from collections import defaultdict

import numpy as np

from concord.llm import minmax_dedup, simhash_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def brute(rows, words, percent=80):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows, by all pairs that share a shingle."""
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                shared[j] += 1
            holders[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    members = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        members[root(i)].append(doc)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()}
    out = []
    for i, (doc, _) in enumerate(rows):
        component = least[root(i)] if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc is not None and doc == component))
    return sorted(out, key=repr)


def collected(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=repr)


def test_query_against_all_pairs(spark):
    larger = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{larger}/documents.parquet").collect()]
    found = collected(minmax_dedup.op11_minmax_hashing(spark, larger))
    assert found == brute(rows, 2)
    assert sum(not kept for *_, kept in found) > 20


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    for words in (1, 2, 5):
        assert collected(minmax_dedup.minmax_duplicates(odd_documents, words=words)) == brute(rows, words)
    assert minmax_dedup.minmax_duplicates(no_documents).count() == 0


def test_links_at_the_threshold(spark):
    """Sets of 4 of 5 shingles are linked, of 3 of 4 not; chains of links are one component; other thresholds and columns."""
    w = [f"w{i}" for i in range(40)]
    texts = [" ".join(w[:5]), " ".join(w[:6]), " ".join(w[10:14]), " ".join(w[10:15]), " ".join(w[20:32]), " ".join(w[21:33]), " ".join(w[22:34]), "One", "one ", "", None]
    rows = [(10 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, body string")
    found = minmax_dedup.minmax_duplicates(df, words=2, id_col="id", text_col="body")
    assert collected(found) == brute(rows, 2)
    assert collected(minmax_dedup.minmax_duplicates(df, words=2, similarity=0.75, id_col="id", text_col="body")) == brute(rows, 2, 75)


def test_crowds_of_near_copies(spark):
    """Hundreds of different near copies, and as many texts that share a passage alone."""
    rng = np.random.default_rng(3)
    word = lambda: f"x{rng.integers(100_000)}"
    base, passage = [word() for _ in range(60)], " ".join(word() for _ in range(25))
    rows = []
    for i in range(300):
        copy = list(base)
        copy[rng.integers(60)] = word()
        rows += [(i, " ".join(copy)), (1000 + i, passage + " " + " ".join(word() for _ in range(25)))]
    found = collected(minmax_dedup.minmax_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2))
    assert found == brute(rows, 2)


def test_signatures():
    """Both values of a permutation hit with the similarity's probability, and their share scatters less than that of as many independent ones would."""
    rng = np.random.default_rng(5)
    shares = []
    for _ in range(400):
        numbers = rng.integers(0, 1 << 63, size=30, dtype=np.uint64)
        a, b = (minmax_dedup.minmax_signature(numbers[some], 64) for some in (slice(0, 20), slice(10, 30)))
        shares.append(minmax_dedup.estimated_similarity(a, b))
    independent = 1 / 3 * 2 / 3 / 128
    assert abs(np.mean(shares) - 1 / 3) < 0.01 and np.var(shares) < independent
    long = np.unique(rng.integers(0, 1 << 63, size=3 * minmax_dedup.SLAB, dtype=np.uint64))
    flip, factor = minmax_dedup._RANDOM[0, 3], minmax_dedup._RANDOM[1, 3] << np.uint64(1) | np.uint64(1)
    image = (long ^ flip) * factor
    image ^= image >> np.uint64(32)
    assert minmax_dedup.minmax_signature(long)[6:8].tolist() == [image.min(), image.max()]


def test_a_text_of_no_partner_has_its_own_shingles(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c d"), (3, "A  B\nC")], "doc_id long, text string")
    assert collected(minmax_dedup.minmax_duplicates(df, words=5)) == [(1, 1, 1, True), (2, 1, 2, True), (3, 1, 1, False)]
    assert simhash_dedup.shingle_hashes("a b c", 5).tolist() == simhash_dedup.shingle_hashes("A  B\nC", 5).tolist()


def test_bitmap_keeps_all_that_is_asked_for(spark):
    rows = spark.range(50_000).selectExpr("id * 977 AS name", "id AS n")
    some = rows.where("n % 10 = 3").select("name")
    kept = minmax_dedup.maybe_in(rows, some, "name", 5000)
    assert kept.columns == rows.columns and kept.where("n % 10 = 3").count() == 5000 and kept.count() < 20_000
    assert minmax_dedup.maybe_in(rows, some.limit(0), "name", 0).count() == 0
