"""SimHash near-duplicate detection by a binary trie self-join (operator 3).

Fingerprints. Words are runs of characters other than the six ASCII blanks, A-Z lower-cased;
shingles of `words` words are hashed with XXH64 (seed 42); a bit of the fingerprint is set when it
is set in over half of the hashes. Python workers do this in Arrow batches.

Self-join. All distinct fingerprints form a binary trie. Two nodes of one depth are visited
together; their differing bits add up, and a pair is dropped once it exceeds the error budget.
Of two fingerprints within k bits, one 32-bit half differs in at most k // 2 bits, so the join
runs over two tries, one that starts at each half, with budget k // 2 down to depth 32 and k below.
That loses no link and keeps the frontier narrow.

On Spark the top levels are unrolled. The fingerprints of one node at `depth` (its first bits; depth grows with the logarithm of
the corpus) are gathered into blocks of about `node_rows`, each one row that holds an array: a crowd of near copies makes several
blocks of one node, so no row and no group grows with the data. A block goes to every node pair
(own node, other node) that the budget allows, found by XOR with the masks of few bits, and every pair of blocks is a group of two rows.
Within a group numpy walks both subtries a level at a time, nearest nodes first and a bounded number of node pairs at a time; node pairs whose
fingerprints are linked to each other already are left out. The group hands on a spanning forest of its links, never all
pairs, so the rows it makes are fewer than the fingerprints it reads.

Filtering. To filter a corpus, texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more count as copies. Fingerprints and the trie
self-join above link the nearest of them. Sets of similarity 0.8 may differ in some ten bits, a budget at which a trie leaves little out, so that the join
has the operator's budget and the rest are found besides: each text names the
first of its shingles in each of 12 random orders, and texts are compared where they share such a shingle. Two texts of similarity J
have no such shingle in common with probability (1 - J) ** 12, which is 4e-9 at 0.8.
Of the pairs that share one, a pair is left out only when it can't be similar: the sizes of the sets are too far
apart, or the numbers of shingles by the last bits of their hashes differ by more in all than the sets may. Such numbers never differ by
more than the sets do, so no similar pair is lost. Links found either way are candidates; each candidate group is then verified on the sets of shingles, exactly.

Components. Labels spread along the forest's edges with pointer jumping; each round ends in a
checkpoint in the shared folder. Only joins and sums that Spark can split are used.

Cases: null or blank texts have fingerprint 0 and link like any other. Texts of fewer words than a shingle
hash as one shingle. Repeated rows share a component. component_id is the smallest id reachable, null
ids aside (null if all are). Ties cannot arise: labels are minima. Very long texts are hashed whole, one at a time. An empty table gives an empty result. Other
input columns are ignored; the filter keeps them.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.workers import then_give_back
from concord.session import cut_lineage

SEED = 42
HALF = 32
#: A profile counts a text's distinct shingles in 2 ** level buckets: a bucket for 8 shingles at most, and so many levels at least.
LEAST_LEVEL = 6
#: _LANES[b] has bit i of the byte b in its byte i, so that adding rows counts eight bits at once.
_LANES = sum((((np.arange(256, dtype=np.uint64) >> np.uint64(i)) & np.uint64(1)) << np.uint64(8 * i)) for i in range(8)).astype(np.uint64)

#: Block keys: so many orders of a text's shingles, each given by an odd factor and a number to flip bits with.
BLOCK_KEYS = 12
_ORDERS = np.random.default_rng(SEED).integers(0, 1 << 63, size=(BLOCK_KEYS, 2), dtype=np.uint64) | np.array([0, 1], dtype=np.uint64)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; empty for a text without words."""
    joined = b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split())
    if not joined:
        return np.empty(0, dtype=np.uint64)
    blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    if len(blanks) < words:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    starts = [0, *(blanks[: len(blanks) - words + 2] + 1).tolist()]
    ends = [*blanks[words - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)), dtype=np.uint64, count=len(ends))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, words: int) -> int:
    return _majority(shingle_hashes(text, words))


def _majority(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    blocks = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)  # a byte of a lane counts to 255
    ones = np.ascontiguousarray(blocks).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def _block_keys(hashes: np.ndarray) -> list[int]:
    """For each of BLOCK_KEYS orders of the shingles: the first shingle, as a number that also names the order."""
    if not len(hashes):
        return [0]
    first = ((hashes[None, :] ^ _ORDERS[:, :1]) * _ORDERS[:, 1:]).min(axis=1)
    return (first ^ (np.arange(BLOCK_KEYS, dtype=np.uint64) << np.uint64(60))).view(np.int64).tolist()


def profile(distinct: np.ndarray) -> np.ndarray:
    """How many of the distinct hashes have each ending, 255 at most: a byte for each of 2 ** level endings."""
    level = max(LEAST_LEVEL, math.ceil(math.log2(max(len(distinct), 1) / 8)))
    return np.minimum(np.bincount((distinct & np.uint64((1 << level) - 1)).astype(np.int64), minlength=1 << level), 255).astype(np.uint8)


def _folded(found: np.ndarray, width: int) -> np.ndarray:
    """The profile by fewer bits: the same as if it had been counted so."""
    return np.minimum(found.reshape(-1, width).sum(axis=0, dtype=np.int64), 255).astype(np.uint8)


def may_be_similar(profiles: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float, slab: int = 1 << 22) -> np.ndarray:
    """False only for pairs of rows whose sets can't have a Jaccard similarity of `similarity`.

    Sets of n members together and similarity J differ in n * (1 - J) / (1 + J) members, and their profiles in no more than these."""
    most = (sizes[left] + sizes[right]) * (1 - similarity) / (1 + similarity) + 1e-4
    width = np.array([len(p) for p in profiles], dtype=np.int64)
    narrow = np.minimum(width[left], width[right])
    hit = np.zeros(len(left), dtype=bool)
    for w in np.unique(narrow).tolist():
        here = np.flatnonzero(narrow == w)
        rows = np.unique(np.concatenate([left[here], right[here]]))
        counts = np.stack([_folded(profiles[r], w) if width[r] > w else profiles[r] for r in rows])
        a, b = np.searchsorted(rows, left[here]), np.searchsorted(rows, right[here])
        step = max(1, slab // w)
        for k in range(0, len(here), step):
            x, y = counts[a[k : k + step]], counts[b[k : k + step]]
            hit[here[k : k + step]] = (np.maximum(x, y) - np.minimum(x, y)).sum(axis=1, dtype=np.int64) <= most[here[k : k + step]]
    return hit


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id fp (the 64 bits as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_majority(shingle_hashes(t.as_py(), words)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, fp long")


def blocking(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, block keys, and the size and the profile of the set of shingles of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []  # of one text at a time, so that a batch of long texts holds no hashes but those of one
            for t in b.column(1):
                hashes = shingle_hashes(t.as_py(), words)
                distinct = np.unique(hashes)
                found.append((_majority(hashes), _block_keys(distinct), len(distinct), profile(distinct).tobytes()))
            fps, keys, sizes, profiles = zip(*found, strict=True) if found else ([], [], [], [])
            columns = [b.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(keys, type=pa.list_(pa.int64())), pa.array(sizes, type=pa.int64()), pa.array(profiles, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "keys", "size", "profile"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(lambda batches: then_give_back(run(batches)), f"doc_id {kind}, fp long, keys array<long>, size long, profile binary")


def _masks(bits: int, most: int) -> list[int]:
    return [sum(1 << i for i in some) for n in range(most + 1) for some in itertools.combinations(range(bits), n)]


def _expand(lo: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range (lo, count): the number of its range and each index in it."""
    owner = np.repeat(np.arange(len(lo)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner] + lo[owner]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class Links:
    """Union-find over the fingerprints of a group: the links found, less those within one tree, are a spanning forest."""

    def __init__(self, n: int, ia: np.ndarray, ib: np.ndarray):
        self.parent, self.kept = np.arange(n), []
        self.ia, self.ib = ia, ib
        self._settle()

    def _settle(self) -> None:
        self.ra, self.rb = self.parent[self.ia], self.parent[self.ib]
        self.ca, self.cb = (np.concatenate([[0], np.cumsum(r[1:] != r[:-1])]) for r in (self.ra, self.rb))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        found = _forest(self.parent, self.ia[i], self.ib[j])
        if found:
            self.kept += found
            self._settle()

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.ra[i] != self.rb[j]

    def open(self, front: np.ndarray) -> np.ndarray:
        """False for node pairs all of whose fingerprints are in one tree."""
        alo, ahi, blo, bhi = front
        return (self.ra[alo] != self.rb[blo]) | (self.ca[alo] != self.ca[ahi - 1]) | (self.cb[blo] != self.cb[bhi - 1])


def walk_trie(a: np.ndarray, b: np.ndarray, depth: int, budget: int, half: int, links: Links, same: bool = False, leaf: int = 24, pairs: int = 1 << 15, slab: int = 1 << 18) -> None:
    """Gives links the pairs of a and b (sorted, distinct, each of one node at `depth`) within `budget` bits, of which
    at most `half` in the first 32, but for those that it holds together already. Node pairs are walked together, one bit a level, until
    both are small; at most `pairs` node pairs or `slab` fingerprint pairs at a time. same: a is b, and a pair of nodes is walked in one order only."""
    if not len(a) or not len(b):
        return
    waiting = [(depth, np.array([[0], [len(a)], [0], [len(b)]]))]
    while waiting:
        depth, front = waiting.pop()
        front = front[:, links.open(front)]
        size = (front[1] - front[0]) * (front[3] - front[2])
        small = np.maximum(front[1] - front[0], front[3] - front[2]) <= leaf if depth < 64 else np.ones(len(size), dtype=bool)
        now = min(pairs, max(1, int(np.searchsorted(np.cumsum(np.where(small, size, 0)), slab, side="right"))))
        if now < len(size):
            waiting.append((depth, front[:, now:]))
            front, small = front[:, :now], small[:now]
        if small.any():
            _leaves(a, b, front[:, small], budget, half, links)
            front = front[:, ~small]
        if front.shape[1]:
            waiting.append((depth + 1, _children(a, b, front, depth, budget, half, same)))


def _children(a: np.ndarray, b: np.ndarray, front: np.ndarray, depth: int, budget: int, half: int, same: bool) -> np.ndarray:
    """The pairs of children of node pairs that are within the budget, nearest first."""
    shift = np.uint64(63 - depth)

    def split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        prefix = (values[lo] >> shift) | np.uint64(1)
        return np.clip(np.searchsorted(values, prefix << shift), lo, hi)

    alo, ahi, blo, bhi = front
    am, bm = split(a, alo, ahi), split(b, blo, bhi)
    out = np.concatenate([np.stack(c) for c in ((alo, am, blo, bm), (alo, am, bm, bhi), (am, ahi, blo, bm), (am, ahi, bm, bhi))], axis=1)
    live = (out[1] > out[0]) & (out[3] > out[2])
    if same:
        live &= out[0] <= out[2]
    out = out[:, live]
    bits = _popcount((a[out[0]] ^ b[out[2]]) >> shift)
    live = bits <= (half if depth < HALF else budget)
    return out[:, live][:, np.argsort(bits[live], kind="stable")]


def _leaves(a: np.ndarray, b: np.ndarray, front: np.ndarray, budget: int, half: int, links: Links) -> None:
    alo, ahi, blo, bhi = front
    nb = bhi - blo
    owner, k = _expand(np.zeros(len(nb), dtype=np.int64), (ahi - alo) * nb)
    i, j = alo[owner] + k // nb[owner], blo[owner] + k % nb[owner]
    open_ = links.apart(i, j)
    i, j = i[open_], j[open_]
    bits = a[i] ^ b[j]
    hit = (_popcount(bits) <= budget) & (_popcount(bits >> np.uint64(HALF)) <= half)
    links.add(i[hit], j[hit])


def _forest(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Adds links to the union-find in parent; the links that joined two trees."""
    kept = []
    while len(left):
        while True:  # point every entry at its root
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up
        ra, rb = parent[left], parent[right]
        apart = ra != rb
        left, right, ra, rb = left[apart], right[apart], ra[apart], rb[apart]
        if not len(left):
            break
        high, low = np.maximum(ra, rb), np.minimum(ra, rb)
        _, first = np.unique(high, return_index=True)  # each root is hung once a round, below a smaller one
        parent[high[first]] = low[first]
        kept += list(zip(left[first].tolist(), right[first].tolist(), strict=True))
    return kept


def _forest_of(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """The links that a spanning forest of them needs."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    found = _forest(np.arange(len(nodes)), at[: len(left)], at[len(left) :])
    return [(int(nodes[i]), int(nodes[j])) for i, j in found]


def _turned(values: np.ndarray, turn: int) -> np.ndarray:
    v = values.view(np.uint64)
    return v if not turn else (v << np.uint64(HALF)) | (v >> np.uint64(HALF))


def links_of_group(low: np.ndarray, high: np.ndarray | None, turn: int, depth: int, budget: int, half: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks of turned fingerprints, or within low where high is None."""
    a = np.sort(low)
    b = a if high is None else np.sort(high)
    every = a if high is None else np.union1d(a, b)
    links = Links(len(every), np.searchsorted(every, a), np.searchsorted(every, b))
    walk_trie(a, b, depth, budget, half, links, same=high is None)
    whole = _turned(every, turn).view(np.int64)  # turning twice by half of the bits restores them
    return [(int(whole[i]), int(whole[j])) for i, j in links.kept]


def trie_self_join(fps: DataFrame, budget: int, total: int, node_rows: int = 8192) -> DataFrame:
    """Edges (u, v) that connect all distinct values of fps.fp within `budget` bits, of which there are `total`; fps.fp is distinct."""
    depth = min(28, max(3, math.ceil(math.log2(max(total, 1) / node_rows))))
    turned = F.array(
        F.struct(F.lit(0).cast("long").alias("turn"), F.col("fp").alias("key")),
        F.struct(F.lit(1).cast("long").alias("turn"), F.shiftleft("fp", HALF).bitwiseOR(F.shiftrightunsigned("fp", HALF)).alias("key")),
    )
    rows = fps.select(F.explode(turned).alias("t")).select("t.turn", "t.key", F.shiftrightunsigned("t.key", 64 - depth).alias("node"))
    nodes = cut_lineage(rows.groupBy("turn", "node").agg(F.ceil(F.count("*") / F.lit(node_rows)).cast("int").alias("blocks")))
    deal = F.pmod(F.hash("key", F.lit(7)), F.col("blocks"))
    dealt = rows.join(nodes, ["turn", "node"]).select("turn", "node", "key", _place("node", deal).alias("mine"))
    held = cut_lineage(dealt.groupBy("turn", "node", "mine").agg(F.collect_list("key").alias("keys")))
    # Every pair of a node with another (or itself) meets in one group for each pair of their blocks.
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(depth, budget // 2)])
    visits = held.select("keys", "turn", "node", "mine", F.explode(masks).alias("mask")).select("keys", "turn", "mine", F.col("node").bitwiseXOR(F.col("mask")).alias("other"))
    reach = nodes.select("turn", F.col("node").alias("other"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    reach = reach.select("turn", "other", _place("other", F.col("block")).alias("theirs"))
    met = visits.join(reach, ["turn", "other"]).select("keys", F.least("mine", "theirs").alias("low"), F.greatest("mine", "theirs").alias("high"), (F.col("mine") > F.col("theirs")).alias("side"))

    def join_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        side = rows["side"].to_numpy(bool)
        low, high = (np.concatenate([np.asarray(k, dtype=np.int64) for k in rows["keys"][some]]).view(np.uint64) if some.any() else None for some in (~side, side))
        found = links_of_group(low, high, int(key[0]) >> 60, depth, budget, budget // 2)
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return met.groupBy("low", "high").applyInPandas(join_group, "u long, v long")


def _place(node: str, block: Column) -> Column:
    """Tree, node and block in one number."""
    return F.shiftleft("turn", 60) + F.shiftleft(node, 32) + block


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component, as signed longs) for every node that has an edge. Labels only get smaller, so the rounds end."""
    both = cut_lineage(edges.select("u", "v").union(edges.select("v", "u")).distinct())
    labels = both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label"))
    labels = cut_lineage(labels)
    while True:
        heard = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, labels["node"] == heard["u"]).select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        jump = lower.select(F.col("node").alias("at"), F.col("label").alias("further"))
        stepped = cut_lineage(lower.join(jump, lower["label"] == jump["at"]).select("node", "was", F.least("label", "further").alias("label")))
        labels = stepped.select("node", "label")
        if stepped.where("label <> was").isEmpty():
            return labels


def _slabs(left: np.ndarray, first: np.ndarray, end: np.ndarray, slab: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each row of left with those from its first to before its end, about `slab` pairs at a time."""
    counts = np.maximum(end - first, 0)
    upto = np.cumsum(counts)
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + slab, side="right")))
        owner, other = _expand(first[at:to], counts[at:to])
        yield left[at:to][owner], other
        at = to


def blocked_self_join(texts: DataFrame, similarity: float, small: int = 256, node_rows: int = 4096, group_rows: int = 8192) -> DataFrame:
    """Edges (u, v) that connect the texts (name, keys, size, profile) that share a block key and may be similar by their sizes and profiles.

    texts is a stored table or a checkpoint: it is read several times, and only keys that several texts share are kept in between.
    Keys of up to `small` texts are compared many to a group; a larger one is dealt into blocks by size, and each pair of blocks that may hold similar sets is a group."""
    rows = texts.select("name", F.explode("keys").alias("key"))
    shared = cut_lineage(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    met = cut_lineage(rows.join(shared, "key"))
    groups = max(1, math.ceil(met.where(F.col("n") <= small).count() / group_rows))
    held = ["name", "size", "profile"]

    def links(rows: pd.DataFrame, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        names, at = np.unique(rows["name"].to_numpy(np.int64), return_inverse=True)
        profiles, sizes = [np.frombuffer(p, dtype=np.uint8) for p in rows["profile"]], rows["size"].to_numpy(np.int64)
        parent = np.arange(len(names))
        kept: list[tuple[int, int]] = []
        for i, j in pairs:
            open_ = parent[at[i]] != parent[at[j]]  # texts that are together already need no link
            i, j = i[open_], j[open_]
            near = may_be_similar(profiles, sizes, i, j, similarity)
            kept += _forest(parent, at[i[near]], at[j[near]])
        return pd.DataFrame([(int(names[i]), int(names[j])) for i, j in kept], columns=["u", "v"], dtype="int64")

    def bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest size of a set that may be similar to one of each size."""
        return np.ceil(sizes * similarity - 1e-4).astype(np.int64), np.floor(sizes / similarity + 1e-4).astype(np.int64)

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "size"], ignore_index=True)
        sizes, (_, kind) = rows["size"].to_numpy(np.int64), np.unique(rows["key"].to_numpy(), return_inverse=True)
        here = np.arange(len(rows))
        order = (kind << 40) + sizes
        # Each row with those after it in its key, as far as sizes go.
        return links(rows, _slabs(here, here + 1, np.searchsorted(order, (kind << 40) + bounds(sizes)[1], side="right"), 1 << 16))

    def join_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "size"], ignore_index=True)
        sizes, n = rows["size"].to_numpy(np.int64), int((~rows["side"].to_numpy(bool)).sum())
        least, most = bounds(sizes[:n])
        here = np.arange(n)
        if key[1] == key[2]:
            return links(rows, _slabs(here, here + 1, np.searchsorted(sizes, most, side="right"), 1 << 16))
        return links(rows, _slabs(here, n + np.searchsorted(sizes[n:], least), n + np.searchsorted(sizes[n:], most, side="right"), 1 << 16))

    few = met.where(F.col("n") <= small).select("name", "key", F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group"))
    few = few.join(texts.select(*held), "name")
    # Similar sets are of about one size: only blocks of one class of sizes, or of two that are side by side, meet.
    kind = F.floor(F.ln(F.greatest(F.col("size"), F.lit(1))) / (1.0001 * math.log(1 / similarity))).cast("int")
    of_key = met.where(F.col("n") > small).join(texts.select(*held), "name").withColumn("kind", kind)
    counts = of_key.groupBy("key", "kind").agg(F.ceil(F.count("*") / node_rows).cast("int").alias("blocks"))
    counts = cut_lineage(counts.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("kind", "blocks"))).alias("blocks")))
    place = lambda kind, block: F.shiftleft(kind, 22) + block
    blocks = lambda kind: F.coalesce(F.try_element_at("blocks", kind), F.lit(0))
    met_by = F.flatten(F.transform(F.array(*[F.col("kind") + d for d in (-1, 0, 1)]), lambda k: F.when(blocks(k) > 0, F.transform(F.sequence(F.lit(0), blocks(k) - 1), lambda j: place(k, j))).otherwise(F.array().cast("array<int>"))))
    dealt = of_key.join(counts, "key").withColumn("mine", place(F.col("kind"), F.pmod(F.hash("name", F.lit(7)), blocks(F.col("kind")))))
    many = dealt.select(*held, "key", "mine", F.explode(met_by).alias("theirs")).select(
        *held, "key", F.least("mine", "theirs").alias("low"), F.greatest("mine", "theirs").alias("high"), (F.col("mine") > F.col("theirs")).alias("side")
    )
    schema = "u long, v long"
    return few.groupBy("group").applyInPandas(compare, schema).unionByName(many.groupBy("key", "low", "high").applyInPandas(join_group, schema))


def near_duplicates(docs: DataFrame, words: int = 4, budget: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed) and component_id of every row."""
    marked = cut_lineage(fingerprints(docs, words, id_col, text_col))
    least = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    labels = components(trie_self_join(least.select("fp"), budget, least.count()))
    grouped = least.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = cut_lineage(grouped.groupBy("label").agg(F.min("first_id").alias("component_id")))
    of_fp = cut_lineage(grouped.join(smallest, "label").select("fp", "component_id"))
    return marked.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 4096) -> np.ndarray:
    """How many members the sets of rows `left` share with those of other rows `right`, by products of 0/1 matrices, a slab of columns at a time."""
    rows = np.unique(np.concatenate([left, right]))
    owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    _, column, often = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    some = often[column] > 1  # a member of one set only is shared with none
    _, column = np.unique(column[some], return_inverse=True)
    owner = owner[some]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    a, b = np.searchsorted(rows, left), np.searchsorted(rows, right)
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        low, high = np.searchsorted(column, [first, first + columns])
        present = np.zeros((len(rows), columns), dtype=np.float32)
        present[owner[low:high], column[low:high] - first] = 1
        shared += present[a] @ present[b].T
    return shared


def similar_links(names: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest, by name, of the pairs of a left and a right row whose sets have a Jaccard similarity of `similarity` or more."""
    shared = shared_counts(sets, left, right)
    size = lambda rows: np.array([len(sets[r]) for r in rows])
    either = size(left)[:, None] + size(right)[None, :] - shared
    # Texts without words have empty sets; they are equal to each other.
    i, j = np.nonzero(np.where(either == 0, True, shared >= similarity * either - 1e-4))
    return [(int(names[x]), int(names[y])) for x, y in _forest_of(left[i], right[j])]


def verified_links(members: DataFrame, groups: int, words: int, similarity: float, small: int = 64, block_rows: int = 512) -> DataFrame:
    """As verified_sets, from texts. members: name, label, n (the label's texts), text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), words)).view(np.int64) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sets, type=pa.list_(pa.int64()))], names=["name", "label", "n", "shingles"])

    held = members.select("name", "label", "n", "text").mapInArrow(lambda batches: then_give_back(run(batches)), "name long, label long, n long, shingles array<long>")
    return verified_sets(held, groups, similarity, small, block_rows)


def verified_sets(held: DataFrame, groups: int, similarity: float, small: int = 64, block_rows: int = 512) -> DataFrame:
    """Edges (u, v) between the texts of one label that are similar. held: name, label, n (the label's texts), shingles; names are distinct.

    Labels of few texts are verified many to a group, in `groups` groups; a larger one is dealt into blocks, and each pair of blocks is
    a group. Either way a group is bounded."""
    few = F.col("n") <= small
    blocks = F.when(few, 1).otherwise(F.ceil(F.col("n") / block_rows)).cast("int")
    dealt = held.withColumns({"blocks": blocks, "mine": F.pmod(F.hash("name", F.lit(7)), blocks), "unit": F.when(few, F.pmod(F.xxhash64("label"), F.lit(groups))).otherwise(F.col("label"))})
    met = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("theirs")).select(
        "name", "label", "shingles", few.alias("few"), "unit", F.least("mine", "theirs").alias("low"), F.greatest("mine", "theirs").alias("high"), (F.col("mine") > F.col("theirs")).alias("side")
    )

    def verify(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["label", "name"], ignore_index=True)
        names, labels, sets = rows["name"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), list(rows["shingles"])
        if key[0] or key[2] == key[3]:
            parts = [(k, k) for k in np.split(np.arange(len(rows)), np.flatnonzero(labels[1:] != labels[:-1]) + 1)]
        else:
            side = rows["side"].to_numpy(bool)
            parts = [(np.flatnonzero(~side), np.flatnonzero(side))]
        found = [link for left, right in parts for link in similar_links(names, sets, left, right, similarity)]
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return met.groupBy("few", "unit", "low", "high").applyInPandas(verify, "u long, v long")


def trie_links(texts: DataFrame, budget: int) -> DataFrame:
    """Edges (u, v) that connect the texts (name, fp) whose fingerprints are connected within `budget` bits, by the trie self-join. texts is a checkpoint."""
    least = cut_lineage(texts.groupBy("fp").agg(F.min("name").alias("first")))
    edges = trie_self_join(least.select("fp"), budget, least.count())
    left, right = (least.select(F.col("fp").alias(end), F.col("first").alias(f"first_{end}")) for end in ("u", "v"))
    met = edges.join(left, "u").join(right, "v").select(F.col("first_u").alias("u"), F.col("first_v").alias("v"))
    return met.unionByName(texts.join(least, "fp").where("name <> first").select(F.col("first").alias("u"), F.col("name").alias("v")))


def keep_one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", budget: int = 4) -> DataFrame:
    """One row of docs for each group of similar texts: that of the smallest id (null ids last), then of the smallest text hash.

    Texts are similar whose sets of shingles have a Jaccard similarity of `similarity` or more; groups are their connected components.
    Candidates come from the trie self-join of fingerprints and, for similar texts that differ in more than `budget` bits, from the join by block keys; each link
    is then verified on the sets themselves. Two 64-bit hashes stand for a text; distinct texts are numbered."""
    no_id, name = F.col(id_col).isNull(), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashes = [F.xxhash64(whole).alias("h1"), F.xxhash64(F.lit("second"), whole).alias("h2")]
    key = F.struct(no_id.alias("no_id"), F.col(id_col).alias("id"), name.alias("id_text"), *hashes)
    keyed = docs.select(key.alias("row"), F.col(text_col).alias("text"))
    marked = cut_lineage(blocking(keyed, words, "row", "text").withColumnRenamed("doc_id", "row"))
    # One row stands for each distinct text, so copies are not compared.
    distinct = marked.groupBy("row.h1", "row.h2").agg(F.min("row").alias("row"), *[F.first(c).alias(c) for c in ("fp", "keys", "size", "profile")])
    texts = cut_lineage(distinct.drop("h1", "h2").withColumn("name", F.monotonically_increasing_id()))
    near = components(trie_links(texts, budget).unionByName(blocked_self_join(texts, similarity))).withColumnRenamed("node", "name")
    labelled = cut_lineage(texts.select("name", "row").join(near, "name"))
    crowded = cut_lineage(labelled.groupBy("label").agg(F.count("*").alias("n")).where("n > 1"))
    where = ["no_id", "id_text", "h1", "h2"]
    asked = labelled.join(crowded, "label").select(*[F.col(f"row.{c}") for c in where], "name", "label", "n")
    of_row = [no_id.alias("no_id"), name.alias("id_text"), *hashes]
    members = docs.select(*of_row, F.col(text_col).alias("text")).join(asked, where).dropDuplicates(where)  # a row that is repeated counts once; its copies are together already
    groups = max(1, (crowded.agg(F.sum("n")).first()[0] or 0) // 512)
    same = components(verified_links(members, groups, words, similarity)).withColumnRenamed("node", "name").withColumnRenamed("label", "component")
    kept = texts.select("name", "row").join(same, "name", "left").groupBy(F.coalesce("component", "name")).agg(F.min("row").alias("row")).select(*[F.col(f"row.{c}") for c in where])
    # The row goes along as one struct, so that no column of docs can clash with these. Copies of a row, equal in id and text, become one in each task before they are shuffled.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *of_row).dropDuplicates(where).join(kept, where, "left_semi")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op3_simhash_trie(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, budget=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
