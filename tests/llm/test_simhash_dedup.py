from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from concord.llm import simhash_dedup as s


def brute_fingerprint(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, budget):
    """Smallest index reachable over pairs within the budget."""
    fps = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= budget
    label = np.arange(len(fps))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def clustered(n, spread, rng):
    """Fingerprints around a few centres, so that many pairs lie near the budget."""
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 20))]
    return sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(spread))) for c in centres for _ in range(20)})


@pytest.mark.parametrize("text", ["", " \t", "a", "A b C", "A b c d", "one two three four five six", "x " * 700, "ÀB cd ÉF gh ij \x1c kl", "tie tie"])
@pytest.mark.parametrize("words", [4, 5])
def test_fingerprint(text, words):
    assert s.fingerprint(text, words) == brute_fingerprint(text, words)


class EveryPair:
    """Stands for Links and leaves nothing out."""

    def __init__(self):
        self.found = set()

    def open(self, front):
        return np.ones(front.shape[1], dtype=bool)

    def apart(self, i, j):
        return np.ones(len(i), dtype=bool)

    def add(self, i, j):
        self.found |= set(zip(i.tolist(), j.tolist(), strict=True))


@pytest.mark.parametrize("bounds", [{}, {"pairs": 5, "slab": 20}])
@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("budget", [0, 3, 4, 6])
def test_trie_pairs(same, budget, bounds):
    a = np.array(clustered(400, 7, random.Random(1)), dtype=np.uint64)
    b = a if same else np.unique(np.concatenate([a[::2] ^ np.uint64(5), a[1::3]]))
    apart = a[:, None] ^ b[None, :]
    wanted = {(int(i), int(j)) for i, j in zip(*np.nonzero((np.bitwise_count(apart) <= budget) & (np.bitwise_count(apart >> np.uint64(32)) <= budget // 2)), strict=True)}
    every = EveryPair()
    s.walk_trie(a, b, 0, budget, budget // 2, every, same, leaf=3, **bounds)
    found = every.found
    assert ({tuple(sorted(p)) for p in found} == {tuple(sorted(p)) for p in wanted}) if same else found == wanted


def crowd(n, bits, rng):
    """Fingerprints around one centre, some of them out of reach of all others."""
    centre = rng.getrandbits(64)
    return np.array(sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(bits))) for _ in range(n)}), dtype=np.uint64)


@pytest.mark.parametrize("turn", [0, 1])
def test_links_of_a_crowd(turn):
    """Leaving out node pairs that are linked already loses no component; the links are a forest."""
    fps = crowd(3000, 9, random.Random(5))
    keys = s._turned(fps, turn)
    low, high = keys[::2], keys[1::2]
    found = s.links_of_group(low, None, turn, 0, 4, 2) + s.links_of_group(high, None, turn, 0, 4, 2) + s.links_of_group(low, high, turn, 0, 4, 2)
    for some, links in ((low, s.links_of_group(low, None, turn, 0, 4, 2)), (keys, found)):
        own = np.sort(some)
        near = (np.bitwise_count(own[:, None] ^ own[None, :]) <= 4) & (np.bitwise_count((own[:, None] ^ own[None, :]) >> np.uint64(32)) <= 2)
        index = {int(s._turned(own[k : k + 1], turn).view(np.int64)[0]): k for k in range(len(own))}
        both = [np.arange(len(own)), np.arange(len(own))]
        wanted = s._forest(both[0], *np.nonzero(near))
        got = s._forest(both[1], np.array([index[u] for u, _ in links]), np.array([index[v] for _, v in links]))
        assert len(got) == len(wanted) and (both[0] == both[1]).all()
    assert len(s.links_of_group(low, None, turn, 0, 4, 2)) < len(low)


def labels_of(spark, fps, edges):
    index = {int(np.uint64(f).view(np.int64)): k for k, f in enumerate(fps)}
    label = np.arange(len(fps))
    found = {r["node"]: r["label"] for r in s.components(edges).collect()}
    least = {}
    for node, l in found.items():
        least[l] = min(least.get(l, len(fps)), index[node])
    for node, l in found.items():
        label[index[node]] = least[l]
    return label


@pytest.mark.parametrize("node_rows", [8192, 40])
def test_self_join_finds_all_components(spark, node_rows):
    """Small nodes force crowded ones to be dealt into blocks."""
    fps = clustered(600, 7, random.Random(2))
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    assert (labels_of(spark, fps, s.trie_self_join(df, 4, len(fps), node_rows)) == brute_components(fps, 4)).all()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 100)]
    edges = chain + star + [(5000, 5001)]
    rng.shuffle(edges)
    found = {r["node"]: r["label"] for r in s.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(201)) and all(found[1000 + i] == 1000 for i in range(100)) and found[5001] == 5000


def test_documents(spark, sf_dir, documents):
    texts = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    fps = [brute_fingerprint(t, 4) for _, t in texts]
    label = brute_components(fps, 4)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in s.op3_simhash_trie(spark, sf_dir).collect()}
    assert found == {i: (f"{f:016x}", texts[k][0]) for (i, _), f, k in zip(texts, fps, label, strict=True)}


def edited(text, n, rng):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def jaccard_groups(texts, words, similarity):
    """Smallest index of each text's component over all pairs of shingle sets."""
    sets = [set(s.shingle_hashes(t, words).tolist()) for t in texts]
    size = np.array([len(x) for x in sets])
    shared = np.array([[len(a & b) for b in sets] for a in sets])
    either = size[:, None] + size[None, :] - shared
    near = (either == 0) | (shared >= similarity * either)
    label = np.arange(len(texts))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("sizes", [{}, {"small": 3, "block_rows": 2}])
def test_filter_keeps_one_of_similar_texts(spark, sizes, monkeypatch):
    """Families of edited copies, of similarity above and below 0.8, and texts that only share a passage of 60 words."""
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))
    passage, rows = text(60), []
    for k in range(24):
        original = text(100 + 10 * k) + " " + passage
        rows.append((100 * k, original))
        rows += [(100 * k + c, edited(original, 1 + (c * k) % 9, rng)) for c in range(1, 2 + k % 7)]
    if sizes:
        join, verify = s.blocked_self_join, s.verified_links
        monkeypatch.setattr(s, "blocked_self_join", lambda texts, similarity: join(texts, similarity, small=5, node_rows=7, group_rows=50))
        monkeypatch.setattr(s, "verified_links", lambda *a: verify(*a, **sizes))
    kept = {r["doc_id"] for r in s.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    label = jaccard_groups([t for _, t in rows], 5, 0.8)
    assert kept == {rows[k][0] for k in set(label.tolist())}
    assert 24 < len(kept) < len(rows)


def test_forest_connects_what_links_connect():
    left, right = np.array([7, 9, 7, 3, 5]), np.array([9, 7, 3, 9, 5])
    found = s._forest_of(left, right)
    assert len(found) == 2 and {x for link in found for x in link} == {3, 7, 9}
    assert s._forest_of(left[:0], right[:0]) == []


def test_filter_on_documents(documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    label = jaccard_groups([t for _, t in rows], 5, 0.8)
    assert {r["doc_id"] for r in s.keep_one_of_each(documents).collect()} == {rows[k][0] for k in set(label.tolist())}


def test_filter_finds_copies_with_a_repeated_phrase(spark):
    """A phrase repeated in one copy shifts the fingerprint, which counts repeats, but hardly the set of shingles."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**7)}"
    rows = []
    for k, (n, phrase, times) in enumerate([(2000, 10, 45), (1000, 10, 20), (1000, 1, 200)] * 4):
        text = " ".join(word() for _ in range(n))
        rows += [(2 * k, text), (2 * k + 1, text + " " + " ".join([" ".join(word() for _ in range(phrase))] * times))]
    assert (jaccard_groups([t for _, t in rows], 5, 0.8) == np.repeat(np.arange(0, 24, 2), 2)).all()
    assert max((s.fingerprint(a, 5) ^ s.fingerprint(b, 5)).bit_count() for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True)) > 20
    assert {r["doc_id"] for r in s.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == set(range(0, 24, 2))


def test_similar_texts_that_share_few_block_keys_are_linked(spark):
    """Copies of similarity over 0.9 whose edits hit all but two or so of the shingles that are first in an order."""
    rng = random.Random(10)
    rows = []
    for k in range(6):
        text = [f"w{rng.randrange(10**7)}" for _ in range(1000)]
        hashes = s.shingle_hashes(" ".join(text), 5)
        first = ((hashes[None, :] ^ s._ORDERS[:, :1]) * s._ORDERS[:, 1:]).argmin(axis=1)
        copy = list(text)
        for at in first[:10]:
            copy[at + 2] = f"x{rng.randrange(10**7)}"
        sets = [np.unique(s.shingle_hashes(" ".join(t), 5)) for t in (text, copy)]
        assert len(np.intersect1d(*sets)) > 0.9 * len(np.union1d(*sets))
        if 1 <= len(set(s._block_keys(sets[0])) & set(s._block_keys(sets[1]))) <= 3:
            rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(copy))]
    assert len(rows) >= 6
    assert {r["doc_id"] for r in s.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {i for i, _ in rows if i % 2 == 0}


def test_profiles_leave_out_no_similar_pair():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    sets = [np.unique(base[a:b]) for a in (0, 5, 40, 300, 900) for b in (a + 7, a + 60, 500, 620, 4000, 5000, 6000) if b > a]
    sets += [np.full(1, 7, dtype=np.uint64), np.empty(0, dtype=np.uint64), np.arange(300, dtype=np.uint64) << np.uint64(20), np.arange(290, dtype=np.uint64) << np.uint64(20)]
    left, right = np.triu_indices(len(sets))
    shared = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(left, right, strict=True)])
    sizes = np.array([len(x) for x in sets])
    similar = shared >= 0.8 * (sizes[left] + sizes[right] - shared)
    hit = s.may_be_similar([s.profile(x) for x in sets], sizes, left, right, 0.8, slab=1000)
    assert hit[similar].all() and 0 < similar.sum() and not hit.all()


def test_shared_counts():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 40, rng.integers(0, 30))) for _ in range(12)]
    left, right = np.array([0, 3, 5, 11]), np.array([1, 2, 7])
    wanted = [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]
    assert s.shared_counts(sets, left, right, columns=5).tolist() == wanted


def test_odd_documents(odd_documents, no_documents):
    rows = s.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    component = {}
    for r in rows:
        component.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert component[1] == component[2] == {1} and component[3] == component[4] == component[6] == {3} and component[None] == {None}
    assert {r["fp"] for r in rows if r["doc_id"] in (3, 4, 6)} == {0}
    assert s.near_duplicates(no_documents).collect() == []


def test_odd_documents_are_filtered(odd_documents, no_documents):
    kept = s.keep_one_of_each(odd_documents)
    assert kept.schema == odd_documents.schema
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted([1, 3, 5, None, 7, 8], key=repr)
    assert s.keep_one_of_each(no_documents).collect() == []


def test_filter_links_by_the_trie(spark, monkeypatch):
    """Near copies are found by their fingerprints, also where block keys give nothing."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 50_000, 1500)) for _ in range(12)]
    near = [" ".join([*t.split()[:-1], "other"]) for t in texts]
    rows = [(2 * i + k, t) for i, pair in enumerate(zip(texts, near, strict=True)) for k, t in enumerate(pair)]
    bits = [bin(s.fingerprint(a, 5) ^ s.fingerprint(b, 5)).count("1") for a, b in zip(texts, near, strict=True)]
    assert max(bits) <= 4
    monkeypatch.setattr(s, "blocked_self_join", lambda texts, similarity: texts.sparkSession.createDataFrame([], "u long, v long"))
    assert {r["doc_id"] for r in s.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == set(range(0, 24, 2))
