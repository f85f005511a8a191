"""Byte-level BPE encoding and decoding in batched numpy merge rounds (operator 5).

A text is split at its added tokens, then at single ASCII blanks between two other characters, where no token can cross. Distinct
parts are split further by the vocabulary's pattern into words. All unseen words of a slab of texts are
encoded together: their symbols lie in one flat array, the key of each adjacent pair is looked up by binary search in
the sorted keys of the merges, the lowest rank of each word is found by a segmented minimum, and all its pairs
of that rank are merged, left to right. Words without a mergeable pair leave the array. Rounds end when it is empty. Words of more than 512
bytes share another flat array, whose pairs wait by rank: a round takes the lowest, merges it in all words, and looks up the new pairs only, so that a word of a megabyte takes seconds.
Parts and words already encoded stay in dictionaries of bounded entries and bytes, which live as long as the Python worker.

Encoding and decoding look at one document at a time, so the job needs no shuffle. Slabs bound the memory.

Cases: a null or empty text has no ids; its ids and its decoded text are empty strings. Repeated rows give equal rows. An
empty table gives an empty result. Input columns other than the id and the text are ignored. The text of a special token is
encoded as that token, as the vocabulary's library does.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern that splits a text into words, as the vocabulary was made with it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SLAB = 1 << 22
#: Bytes of a word from which on its pairs are kept by rank; bytes of text that the dictionaries may hold.
LONG = 512
HELD = 1 << 25
NONE = np.int64(1) << 40


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class ByteBPE:
    def __init__(self, path: str, most: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        chars = byte_characters()
        byte_of = {c: b for b, c in enumerate(chars)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token = [b""] * size
        for t, i in vocab.items():
            self.token[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        for t, i in self.added.items():
            self.token[i] = t.encode()
        self.decimal = [str(i) for i in range(size)]
        self.size = np.int64(size)
        self.first_ids = np.array([vocab[c] for c in chars], dtype=np.int64)
        keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pattern = regex.compile(WORDS)
        self.clean = re.compile(r"(?<=\S) (?=\S)")
        self.most, self.held = most, 0
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word. Rounds look at every symbol, which is right for many short words; long ones are merged in the order of ranks instead."""
        long = [k for k, w in enumerate(words) if len(w) > LONG]
        if not long:
            return self._rounds(words)
        found = dict(zip(long, self._by_rank([words[k] for k in long]), strict=True))
        short = iter(self._rounds([w for w in words if len(w) <= LONG]))
        return [found[k] if k in found else next(short) for k in range(len(words))]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, by binary search; NONE for pairs that are not merged, and where right is -1."""
        key = np.where(right < 0, np.int64(-1), left * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def _by_rank(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: one flat array, whose pairs wait by rank. A round merges all pairs of the lowest rank, and looks up only the pairs beside them, so all
        rounds together look at each symbol a few times."""
        symbol = np.append(self.first_ids[np.frombuffer(b"".join(words), dtype=np.uint8)], -1)
        n = len(symbol) - 1  # the place behind the end, which no pair has
        ends = np.cumsum([len(w) for w in words])
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], before[np.append(0, ends[:-1])] = n, n
        rank, alive = np.full(n + 1, NONE), np.ones(n + 1, dtype=bool)
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def look_up(places: np.ndarray) -> None:
            rank[places] = found = self._ranks(symbol[places], symbol[after[places]])
            by_rank = np.argsort(found, kind="stable")
            places, found = places[by_rank], found[by_rank]
            places, found = places[: np.searchsorted(found, NONE)], found[: np.searchsorted(found, NONE)]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            for r, some in zip(found[np.append(0, cuts)].tolist() if len(found) else (), np.split(places, cuts), strict=False):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(order, r)
                waiting[r].append(some)

        look_up(np.arange(n))
        while order:
            r = heapq.heappop(order)
            hit = np.unique(np.concatenate(waiting.pop(r)))
            hit = hit[alive[hit] & (rank[hit] == r)]
            if not len(hit):
                continue
            # As in a round: every other pair of a run of pairs that overlap is merged.
            here = np.arange(len(hit))
            begins = np.concatenate([[True], after[hit[:-1]] != hit[1:]])
            hit = hit[(here - np.maximum.accumulate(np.where(begins, here, 0))) % 2 == 0]
            gone = after[hit]
            symbol[hit], alive[gone], rank[gone] = self.merged[r], False, NONE
            after[hit] = after[gone]
            before[after[hit]] = hit
            beside = np.unique(np.concatenate([hit, before[hit]]))
            look_up(beside[beside < n])
        found, owner = symbol[:n][alive[:n]], np.searchsorted(ends, np.flatnonzero(alive[:n]), side="right")
        return np.split(found, np.cumsum(np.bincount(owner, minlength=len(words)))[:-1])

    def _rounds(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by merge rounds over one flat array of all their symbols."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        symbol = self.first_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owners = [], []
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            following = np.full(len(symbol), -1, dtype=np.int64)
            following[:-1] = np.where(owner[1:] == owner[:-1], symbol[1:], -1)
            rank = self._ranks(symbol, following)
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(np.append(first, len(symbol))))
            over = best == NONE
            if over.any():
                done_symbols.append(symbol[over])
                done_owners.append(owner[over])
            hit = np.flatnonzero((rank == best) & ~over)
            # Pairs of equal rank that overlap are runs of one symbol: every other pair of a run is merged.
            run = np.maximum.accumulate(np.where(np.concatenate([[True], hit[1:] != hit[:-1] + 1]), hit, 0)) if len(hit) else hit
            hit = hit[(hit - run) % 2 == 0]
            symbol[hit] = self.merged[rank[hit]]
            over[hit + 1] = True
            symbol, owner = symbol[~over], owner[~over]
        if not done_symbols:
            return [np.empty(0, dtype=np.int64) for _ in words]
        owner = np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(words)))
        return np.split(np.concatenate(done_symbols)[order], ends[:-1])

    def _learn(self, parts: Iterable[str]) -> None:
        """Encodes unseen parts; a part keeps the blank before it."""
        new = [p for p in parts if p not in self.parts]
        if not new:
            return
        if len(self.parts) > self.most or self.held > HELD:
            self.parts.clear()
            self.words.clear()
            self.held, new = 0, list(parts)
        if len(self.words) > self.most:
            self.words.clear()
        split = [self.pattern.findall(p) for p in new]
        unseen = [*{w for ws in split for w in ws}.difference(self.words)]
        self.words.update(zip(unseen, (i.astype("<u4").tobytes() for i in self.encode_words([w.encode("utf-8", "surrogatepass") for w in unseen])), strict=True))
        known = self.words
        self.held += sum(map(len, new)) + sum(map(len, unseen))
        self.parts.update((p, b"".join([known[w] for w in ws])) for p, ws in zip(new, split, strict=True))

    def _parts(self, text: str) -> list[str]:
        first, *rest = self.clean.split(text)
        return [first, *[" " + p for p in rest]] if text else []

    def encode_slab(self, texts: list[str]) -> list[np.ndarray]:
        segments = [self.split_added.split(t) if self.split_added and any(a in t for a in self.added) else [t] for t in texts]
        parts = [[self._parts(s) if k % 2 == 0 else s for k, s in enumerate(own)] for own in segments]
        self._learn({p for own in parts for s in own if isinstance(s, list) for p in s})
        known, out = self.parts, []
        for own in parts:
            found = [b"".join([known[p] for p in s]) if isinstance(s, list) else np.array([self.added[s]], dtype="<u4").tobytes() for s in own]
            out.append(np.frombuffer(b"".join(found), dtype="<u4"))
        return out

    def decode(self, ids: np.ndarray) -> str:
        token = self.token
        return b"".join([token[i] for i in ids.tolist()]).decode("utf-8", "replace")


_MODELS: dict[str, ByteBPE] = {}


def model(path: str) -> ByteBPE:
    if path not in _MODELS:
        _MODELS[path] = ByteBPE(path)
    return _MODELS[path]


def slabs(texts: Iterable[str], most: int = SLAB) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and decoded text of every row."""
    return _per_text(docs, tokenizer_path, id_col, text_col, "ids array<int>, decoded string", lambda bpe, ids: (ids.astype(np.int32), bpe.decode(ids)))


def digest_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text of every row."""

    def digests(bpe: ByteBPE, ids: np.ndarray) -> tuple:
        decimal = bpe.decimal
        joined = ",".join([decimal[i] for i in ids.tolist()])
        return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(bpe.decode(ids).encode("utf-8", "surrogatepass")).hexdigest()

    return _per_text(docs, tokenizer_path, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _per_text(docs: DataFrame, path: str, id_col: str, text_col: str, schema: str, result) -> DataFrame:
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for b in batches:
            at = 0
            for texts in slabs(t.as_py() or "" for t in b.column(1)):
                rows = [result(bpe, ids) for ids in bpe.encode_slab(texts)]
                columns = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), *columns], names=["doc_id", *names])
                at += len(texts)

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, {schema}")


def op5_numpy_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
