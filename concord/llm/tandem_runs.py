"""Periodic runs of words by the linear tandem-repeat method of Gusfield and Stoye (operator 12).

A run is a stretch of words with smallest period q, at least 2 q and at least `least` words long, that can't be extended. A text's words are numbered and
then taken through these steps:

1. Substrings of 2 ** k words get names by prefix doubling. Names give the suffix array and, in a few table reads, how far two
   positions agree forward and backward; all such questions of a step are put at once, in numpy.
2. The Lempel-Ziv blocks of the words. For each block, squares (a word sequence twice) centred in it or reaching into it from before are found from how far
   positions near its two ends agree. These squares cover the leftmost occurrence of every square: each is one of them or a rotation of one.
3. The suffix tree, from the suffix array. Each square's place on its path is marked; from every mark a walk by suffix links goes on to the next
   rotation as long as that is in the tree and not marked. Then all squares of the text are marked, and the leaves below a mark are where the square occurs.
4. Occurrences at consecutive positions with one period merge into a run. Only squares of a sequence that is no repetition itself are
   followed (rotations of one are such again), so the period of a run is its smallest.

A run's words all lie in sequences of `least` // 2 words that occur twice, so words outside of those are left out first: the steps above see the stretches
between them, one at a time, which changes no run. Every document is treated for itself in Arrow batches, and nothing is shuffled.

Cases: null or wordless texts have no runs and stay as they are but for blanks. Repeated rows give equal rows. Very long texts are worked through whole, in memory in proportion to
n log n words (about 8 bytes each). Of equally long runs the first is reported, then that of the smallest period. An empty table gives an empty result. Columns other than the
id and the text are ignored, whatever their names; a null id is a value like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12
RUN = "struct<start:long,length:long,period:long>"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Names:
    """Names of the substrings of 2 ** k symbols: equal names, equal substrings. A substring that the end cuts off differs from all that it does not."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.n = n
        _, first = np.unique(symbols, return_inverse=True)
        self.levels = [np.append(first + 1, 0).astype(np.int64)]  # 0 is the name of what lies behind the end
        while int(self.levels[-1].max()) < n:  # some substrings are still equal
            width = 1 << (len(self.levels) - 1)
            name = self.levels[-1]
            after = np.zeros(n, dtype=np.int64)
            after[: max(0, n - width)] = name[width:n]
            _, longer = np.unique(name[:n] * (n + 1) + after, return_inverse=True)
            self.levels.append(np.append(longer + 1, 0).astype(np.int64))
        self.order = np.argsort(self.levels[-1][:n], kind="stable")

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from a and from b on agree; a and b differ."""
        a, b = a.copy(), b.copy()
        found = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            step = (level[a] == level[b]).astype(np.int64) << k  # at most one of the two is behind the end, where no name is equal
            a, b, found = a + step, b + step, found + step
        return found

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols up to a and up to b agree; a and b differ."""
        a, b = a.copy(), b.copy()
        found = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            x, y = a - (1 << k) + 1, b - (1 << k) + 1
            same = (np.minimum(x, y) >= 0) & (level[np.maximum(x, 0)] == level[np.maximum(y, 0)])
            step = same.astype(np.int64) << k
            a, b, found = a - step, b - step, found + step
        return found


def blocks(names: Names) -> np.ndarray:
    """Starts of the Lempel-Ziv blocks, and the end: each block is the longest sequence that also starts earlier, or one new symbol."""
    n, order = names.n, names.order.tolist()
    # For each position the nearest ranks with a smaller position, above and below: one of them has the longest match.
    above, below, stack = [-1] * n, [-1] * n, []
    for p in order:
        while stack and stack[-1] > p:
            below[stack.pop()] = p
        if stack:
            above[p] = stack[-1]
        stack.append(p)
    here, longest = np.arange(n), np.zeros(n, dtype=np.int64)
    for other in (np.array(above), np.array(below)):
        some = other >= 0
        longest[some] = np.maximum(longest[some], names.forward(here[some], other[some]))
    steps, starts, at = np.maximum(longest, 1).tolist(), [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    return np.array([*starts, n])


def _counted(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the counts c: its index, c times, and the numbers 1 to c."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner] + 1


def covering_squares(names: Names, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of squares that cover the leftmost occurrence of every square of a sequence that is no repetition, by the blocks that starts cut."""
    n, h, end = names.n, starts[:-1], starts[1:]
    length = end - h
    # A square that starts in a block reaches over its end, e: there the second half agrees with what is k before.
    owner, k = _counted(length)
    e = end[owner]
    some = e < n
    e, k = e[some], k[some]
    squares = [_squares_with(names, e - k, k)]
    # One that starts before a block has its start, b, in the first half, and its second half ends in this block or the next.
    owner, k = _counted(length + np.append(length[1:], 0))
    b = h[owner]
    some = b + k < n
    squares.append(_squares_with(names, b[some], k[some]))
    at, half = np.unique(np.concatenate(squares, axis=1), axis=1)
    # Rotations of a square of a repetition are such squares too, so none of them leads to a run of its own.
    single, rest, factor = np.ones(len(at), dtype=bool), half.copy(), _least_factors(int(half.max()) if len(half) else 1)
    while (rest > 1).any():
        here = np.flatnonzero(rest > 1)
        prime = factor[rest[here]]
        part = half[here] // prime
        single[here] &= names.forward(at[here], at[here] + part) < 2 * half[here] - part
        rest[here] //= prime
    return at[single], half[single]


def _squares_with(names: Names, q: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Rows start and half: the first square of half k that has q in its first half, for those q that have one."""
    ahead, behind = names.forward(q, q + k), np.zeros(len(q), dtype=np.int64)
    some = q > 0
    behind[some] = names.backward(q[some] - 1, q[some] + k[some] - 1)
    found = (ahead + behind >= k) & (ahead > 0)
    return np.stack([np.maximum(q - behind, q - k + 1)[found], k[found]])


def _least_factors(most: int) -> np.ndarray:
    """The least prime factor of each number up to most."""
    found = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if found[p] == p:
            multiples = found[p * p :: p]
            multiples[multiples == np.arange(p * p, most + 1, p)] = p
    return found


class SuffixTree:
    """Nodes are numbers: leaves are their positions, inner nodes follow, the root is n. A place in the tree is the node at or below it and a depth."""

    def __init__(self, symbols: np.ndarray, names: Names):
        n, order = names.n, names.order
        shared = names.forward(order[:-1], order[1:]).tolist()
        parent, depth, low, high, position = [0] * n, [n - i for i in range(n)], [0] * n, [0] * n, list(range(n))
        for r, p in enumerate(order.tolist()):
            low[p] = high[p] = r

        def node(d: int, p: int) -> int:
            parent.append(-1), depth.append(d), low.append(0), high.append(0), position.append(p)
            return len(parent) - 1

        ranked = order.tolist()
        open_ = [node(0, 0)]
        low[n], last = 0, ranked[0]
        for r in range(1, n + 1):
            d = shared[r - 1] if r < n else 0
            while depth[open_[-1]] > d:  # last hangs below the deepest open node, which may be done
                parent[last] = open_[-1]
                high[open_[-1]] = r - 1
                last = open_.pop()
            if depth[open_[-1]] < d:
                inner = node(d, position[last])
                low[inner] = low[last]
                open_.append(inner)
            parent[last] = open_[-1]
            if r < n:
                last = ranked[r]
        high[n] = n - 1
        self.n, self.symbols, self.text = n, symbols, symbols.tolist()
        self.parent, self.depth, self.position = parent, depth, position
        self.low, self.high = np.array(low), np.array(high)
        self.child = {}
        for v in range(len(parent)):
            if v != n:
                self.child[(parent[v], self.text[position[v] + depth[parent[v]]])] = v
        self.link = {n: n}

    def suffix_link(self, v: int) -> int:
        """The inner node whose path is that of v without its first symbol."""
        found = self.link.get(v)
        if found is None:
            at = self.position[v] + 1
            above = self.parent[v]
            found = self.link[v] = self.down(self.suffix_link(above) if above != self.n else self.n, at, self.depth[v] - 1)
        return found

    def down(self, v: int, at: int, depth: int) -> int:
        """From v, on the path of the suffix at `at`, to the first node of this depth or more. The path is in the tree, so only branches are looked at."""
        while self.depth[v] < depth:
            v = self.child[(v, self.text[at + self.depth[v]])]
        return v

    def places(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The node at or below each place: the highest above the leaf `at` that is no less deep."""
        up, deep = np.array(self.parent), np.array(self.depth)
        up[self.n] = self.n
        jumps = [up]
        while (jumps[-1] != self.n).any():
            jumps.append(jumps[-1][jumps[-1]])
        here = at.copy()
        for jump in reversed(jumps):
            further = jump[here]
            here = np.where(deep[further] >= depth, further, here)
        return here


def all_squares(tree: SuffixTree, at: np.ndarray, half: np.ndarray) -> list[tuple[int, int]]:
    """(node, half) of every kind of square whose rotations, given by covering squares, are in the tree."""
    text, size = tree.text, len(tree.parent)
    marked: set[int] = set()
    # The links of inner nodes need those of the nodes above, so they are settled from the root down, once.
    for v in sorted(range(tree.n + 1, size), key=tree.depth.__getitem__):
        tree.suffix_link(v)
    for v, h in zip(tree.places(at, 2 * half).tolist(), half.tolist(), strict=True):
        depth = 2 * h
        while h * size + v not in marked:
            marked.add(h * size + v)
            # On to the rotation: the square without its first symbol, and that symbol again.
            p = tree.position[v]
            first, above = text[p], tree.parent[v]
            v = tree.down(tree.suffix_link(above) if above != tree.n else tree.n, p + 1, depth - 1)
            if tree.depth[v] == depth - 1:
                v = tree.child.get((v, first), -1) if v >= tree.n else -1
                if v < 0:
                    break
            elif text[tree.position[v] + depth - 1] != first:
                break
    return [(m % size, m // size) for m in marked]


def runs_of(symbols: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of numbers, by start, then period."""
    symbols = np.asarray(symbols, dtype=np.int64)
    found = [np.empty((0, 3), dtype=np.int64)]
    for low, high in stretches(symbols, least // 2):
        part = _runs(symbols[low:high], least)
        part[:, 0] += low
        found.append(part)
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def stretches(symbols: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The stretches that sequences of `width` symbols which occur twice cover; every run of at least 2 * width symbols lies in one.

    Of a run of period q and length L >= 2 q, the first L - q >= width symbols are found again q further on, which covers all of it. Sequences are
    compared by a 64-bit number; different ones with one number make stretches longer, which changes nothing."""
    n = len(symbols) - width + 1
    if n < 2:
        return []
    numbers = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        numbers = numbers * _FACTOR + symbols[k : k + n].astype(np.uint64) + np.uint64(1)
    order = np.argsort(numbers, kind="stable")
    same = numbers[order[1:]] == numbers[order[:-1]]
    if not same.any():
        return []
    again = np.zeros(len(symbols) + 2, dtype=np.int64)
    again[order[1:][same] + 1] = again[order[:-1][same] + 1] = 1
    cover = np.cumsum(again)
    cover[width:] -= cover[:-width].copy()
    inside = cover > 0  # shifted by one, with nothing before and after
    inside[-1] = False
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _runs(symbols: np.ndarray, least: int) -> np.ndarray:
    none = np.empty((0, 3), dtype=np.int64)
    if len(symbols) < max(least, 2):
        return none
    symbols = np.append(symbols, symbols.max() + 1)  # no suffix is the beginning of another
    names = Names(symbols)
    at, half = covering_squares(names, blocks(names))
    if not len(at):
        return none
    tree = SuffixTree(symbols, names)
    kinds = np.array(all_squares(tree, at, half), dtype=np.int64)
    low, high = tree.low[kinds[:, 0]], tree.high[kinds[:, 0]]
    owner, k = _counted(high - low + 1)
    start, period = names.order[low[owner] + k - 1], kinds[owner, 1]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    first = np.flatnonzero(np.concatenate([[True], (start[1:] != start[:-1] + 1) | (period[1:] != period[:-1])]))
    last = np.append(first[1:], len(start)) - 1
    length = start[last] - start[first] + 2 * period[first]
    return np.stack([start[first], length, period[first]], axis=1)[length >= least]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """For each of n words whether no run holds it after its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(cover)[:n] == 0


def find_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (array of start, length, period, by start and period) and collapsed (the text with each run cut to its first period) of each row.

    Words are what lies between the six ASCII blanks; collapsed joins the words that stay by one space each."""
    kind = docs.schema[id_col].dataType.simpleString()
    of_run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, collapsed = [], []
            for t in b.column(1):
                words = (t.as_py() or "").encode("utf-8", "surrogatepass").split()
                number: dict[bytes, int] = {}
                runs = runs_of(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words)), least)
                found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()])
                if len(runs):
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
                collapsed.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, type=pa.list_(of_run)), pa.array(collapsed, type=pa.string())], names=["doc_id", "runs", "collapsed"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs, of which about a tenth, by the checksum of the id, repeat a stretch of their words up to the end."""
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(F.col("h") / 10).cast("long"), F.when(F.col("words").isNotNull(), F.nullif(F.size("words").cast("long"), F.lit(0)))
    a, p = F.col("a"), F.col("p")
    marked = docs.select("doc_id", "text", h.alias("h"), F.when(F.pmod(h, F.lit(10)) == 0, words).alias("words"))
    dealt = marked.withColumn("a", F.pmod(g, n)).withColumn("p", F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long"))
    repeated = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", (a + F.pmod(i - a, p)).cast("int"))))
    return dealt.select("doc_id", F.when(a.isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_gusfield_stoye_runs(spark, sf_dir: str) -> DataFrame:
    found = find_runs(with_planted_runs(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    r = F.col("runs")
    listed = F.concat_ws("", F.transform(r, lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n"))))
    ranked = F.transform(r, lambda x: F.struct((-x["length"]).alias("shorter"), x["start"].alias("start"), x["period"].alias("period")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.array_min(ranked).alias("best"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length, period = -F.col("best.shorter"), F.col("best.period")
    return best.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
