"""Cost-balanced packing of token sequences (operator 4).

Tokens. Python workers encode whole texts with the named tokenizer and add the end id. White space never joins
tokens in this vocabulary, so a slab of texts is split at ASCII blanks and reduced to its distinct pieces. The library encodes
those not seen before, many in one call, and a dictionary of bounded size keeps them; the ids of the slab are then gathered
in one flat array. A document longer than a sequence is cut
into full sequences from its start; what is left (its tail) is packed with other tails. Only lengths
and checksums leave the worker: a tail carries a checksum for each `grain` tokens, from which the checksum of
any cut at a multiple of `grain` follows, so the ids are never shuffled.

Packing. Tails are dealt at random into groups of about `group_rows`, whose number grows with the corpus.
A sequence costs the sum of linear * length + quadratic * length ** 2 over its pieces (attention stays within a
document). In a group of tails with T tokens there are ceil(T / capacity) sequences; documents in descending order of
length go to the cheapest sequence with room for them. Those that fit nowhere are cut over the rooms left, again
cheapest first, and only what still has no room opens a further sequence. So padding is under one sequence a
group, plus less than `grain` tokens where a cut stopped short.

Cases: a null or empty text is the end id alone. Repeated rows are packed once each. An empty table gives an empty
result. Columns other than the id and the text are ignored. Ties go to the smaller row number and the earlier
sequence.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.workers import then_give_back
from concord.session import cut_lineage

CAPACITY = 2048
END_ID = 1
GRAIN = 32
#: A character that is a word of its own; pieces are encoded together with it between them, JOINED of them at a time.
MARK = "\x01"
JOINED = 200
#: Bytes of text (or one longer text) that a worker encodes at a time.
SLAB = 1 << 22
#: Characters of pieces that the dictionaries may hold.
HELD = 1 << 25
#: The steps by which the vocabulary makes words of a text, and what ends a word's last token.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
WORD_END = "</w>"
#: WORDS for printable ASCII in lower case.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Cost of a document of n tokens: n * LINEAR + n * n * QUADRATIC (feed-forward and attention work in the same unit).
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, grains array<long>"


def joined(values: pa.Array) -> str:
    """All values with line ends between them."""
    return pc.binary_join(pa.LargeListArray.from_arrays([0, len(values)], values), "\n")[0].as_py()


class PieceEncoder:
    """Ids of whole texts by way of their blank-separated pieces (as little-endian 32-bit bytes).

    Pieces that come again in a later slab are kept apart from those seen in one slab only; each kind is forgotten when a slab begins and it exceeds `most`, and all are once they hold HELD characters.
    ASCII pieces are taken apart into words here, where the vocabulary's own steps are the ones stated above, and the words are given to
    its merges alone; all others go through the library as they are."""

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.most, self.held, self.often, self.once, self.words = most, 0, {}, {}, {}
        self.mark = self._library([MARK])[0]
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.merges = None
        if (spec["normalizer"], spec["pre_tokenizer"], spec["model"].get("end_of_word_suffix")) == (NORMALIZER, PRE_TOKENIZER, WORD_END) and not spec["model"].get("dropout"):
            self.merges = Tokenizer(self.tokenizer.model)
            self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True

    def forget(self) -> None:
        """All pieces; the tokenizer stays."""
        self.once, self.often, self.words, self.held = {}, {}, {}, 0

    def _library(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        simple = [p for p in pieces if p.isascii() and p.isprintable() and not self.special.search(p)] if self.merges else []
        self._learn_simple(simple)
        self._learn_any([*set(pieces).difference(simple)])

    def _learn_simple(self, pieces: list[str]) -> None:
        """ASCII pieces, by their words: the ids of many words in one call are cut where a word ends."""
        split = [ASCII_WORDS.findall(p.lower()) for p in pieces]
        new = [*{w for ws in split for w in ws}.difference(self.words)]
        together = [new[k : k + JOINED] for k in range(0, len(new), JOINED)]
        for own, ids in zip(together, self._library([" ".join(own) for own in together], self.merges), strict=True):
            ends, data = (np.flatnonzero(self.ends[ids]) + 1).tolist(), ids.tobytes()
            self.words.update((w, data[4 * a : 4 * b]) for w, a, b in zip(own, [0, *ends[:-1]], ends, strict=True))
        words = self.words
        self.once.update((p, b"".join([words[w] for w in ws])) for p, ws in zip(pieces, split, strict=True))

    def _learn_any(self, pieces: list[str]) -> None:
        """Other pieces: a mark stands between many of one call, and the ids are cut where its id is."""
        alone = [p for p in pieces if MARK in p or not p or len(self.mark) != 1]
        plain = [*set(pieces).difference(alone)]
        together = [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)]
        for own, ids in zip(together, self._library([f" {MARK} ".join(own) for own in together]), strict=True):
            ends = np.flatnonzero(ids == self.mark[0]).tolist()
            data, starts = ids.tobytes(), [0, *[e + 1 for e in ends]]
            self.once.update((p, data[4 * s : 4 * e]) for p, s, e in zip(own, starts, [*ends, len(ids)], strict=True))
        self.once.update((p, ids.tobytes()) for p, ids in zip(alone, self._library(alone), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one flat array, and how many each text has. texts has no nulls."""
        if not len(texts):
            return np.empty(0, dtype="<u4"), np.empty(0, dtype=np.int64)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        pieces = joined(coded.dictionary).split("\n")  # quicker than one conversion each; no piece has a line end
        if self.held > HELD:
            self.forget()
        self.once, self.often, self.words = (d if len(d) <= self.most else {} for d in (self.once, self.often, self.words))
        unsure = [p for p in pieces if p not in self.often]
        self.often.update((p, self.once[p]) for p in unsure if p in self.once)
        new = [p for p in unsure if p not in self.often]
        self.held += sum(map(len, new))
        self._learn(new)
        often, once = self.often, self.once
        found = [often[p] if p in often else once[p] for p in pieces]
        of_piece = np.fromiter((len(f) >> 2 for f in found), dtype=np.int64, count=len(found))
        ids, code = np.frombuffer(b"".join(found), dtype="<u4"), coded.indices.to_numpy()
        length = of_piece[code]
        upto = np.concatenate([[0], np.cumsum(length)])
        # Each place of the output takes the id that is as far from its piece's start.
        shift = (np.cumsum(of_piece) - of_piece)[code] - upto[:-1]
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        return ids[np.arange(upto[-1]) + np.repeat(shift, length)], np.diff(upto[ends])


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def slabs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to `most` at most, or that are one row."""
    upto, first = np.cumsum(sizes), 0
    while first < len(sizes):
        end = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + most, side="right")))
        yield first, end
        first = end


def pieces_of(ids: bytes, capacity: int, grain: int) -> list[tuple[int, int, int, int, list[int] | None]]:
    """start, length, checksum, tokens of the document, and for a tail the checksums of its grains."""
    n, out = len(ids) // 4, []
    for start in range(0, n, capacity):
        part = ids[4 * start : 4 * (start + capacity)]
        tail = [zlib.crc32(part[i : i + 4 * grain]) for i in range(0, len(part), 4 * grain)] if len(part) < 4 * capacity else None
        out.append((start, len(part) // 4, zlib.crc32(part), n, tail))
    return out


def tokenize_and_cut(docs: DataFrame, tokenizer_path: str, capacity: int, grain: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    def cut(texts: pa.Array, first: int) -> tuple[list[int], list[tuple]]:
        ids, counts = encoder(tokenizer_path).encode(texts)
        ends = np.cumsum(counts)
        data, at = np.insert(ids, ends, end_id).astype("<u4", copy=False).tobytes(), [0, *(ends + np.arange(1, len(ends) + 1)).tolist()]
        found = [pieces_of(data[4 * s : 4 * e], capacity, grain) for s, e in zip(at[:-1], at[1:], strict=True)]
        return [first + k for k, own in enumerate(found) for _ in own], [r for own in found for r in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for first, end in slabs(pc.binary_length(texts).to_numpy(), SLAB):
                owners, rows = cut(texts.slice(first, end - first), first)
                columns = [pa.array([r[i] for r in rows], type=pa.int64()) for i in range(4)]
                columns.append(pa.array([r[4] for r in rows], type=pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owners, type=pa.int64())), *columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grains"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # A worker outlives its task, so what it has learned goes with the task: later stages of a job run in the same workers.
    task = lambda batches: then_give_back(run(batches), lambda: encoder(tokenizer_path).forget())
    return picked.mapInArrow(task, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, {PIECES}")


def join_checksums(left: int, right: int, right_bytes: int) -> int:
    """CRC-32 of two byte strings put together, from their checksums and the length of the second."""
    zeros = bytes(right_bytes)
    return zlib.crc32(zeros, left) ^ zlib.crc32(zeros) ^ right


def _checksum(grains: list[int], start: int, length: int, grain: int) -> int:
    """Of the tokens start .. start + length; start is a multiple of grain, and so is the end unless it is the tail's."""
    first, count, left = start // grain, -(-length // grain), length
    value = 0
    for g in grains[first : first + count]:
        value = join_checksums(value, int(g), 4 * min(grain, left))
        left -= grain
    return value


def pack_group(lengths: np.ndarray, capacity: int, grain: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(row, start in the row, length, sequence, offset) for tails of the given lengths."""
    total = int(lengths.sum())
    n = -(-total // capacity)
    room = np.full(n, capacity, dtype=np.int64)
    cost = np.zeros(n)
    out, unfit = [], []

    def put(row: int, start: int, length: int, k: int) -> None:
        out.append((row, start, length, k, capacity - int(room[k])))
        room[k] -= length
        cost[k] += linear * length + quadratic * length * length

    for row in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[row])
        k = int(np.argmin(np.where(room >= length, cost, np.inf)))
        if room[k] >= length:
            put(row, 0, length, k)
        else:
            unfit.append(row)
    for row in unfit:
        start, left = 0, int(lengths[row])
        while left:
            usable = room >= min(grain, left)
            if not usable.any():
                room, cost = np.append(room, capacity), np.append(cost, 0.0)
                usable = np.append(usable, True)
            k = int(np.argmin(np.where(usable, cost, np.inf)))
            length = left if room[k] >= left else int(room[k]) // grain * grain
            put(row, start, length, k)
            start, left = start + length, left - length
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    grain: int = GRAIN,
    end_id: int = END_ID,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    group_rows: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with their sequence_id and offset."""
    cut = tokenize_and_cut(docs, tokenizer_path, capacity, grain, end_id, id_col, text_col)
    pieces = cut_lineage(cut.withColumn("row", F.monotonically_increasing_id()))
    whole = pieces.where(F.col("length") == capacity)
    tails = pieces.where(F.col("length") < capacity)
    groups = max(1, round(tails.count() / group_rows))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        starts, grains = rows["start"].to_numpy(np.int64), rows["grains"]
        placed = pack_group(rows["length"].to_numpy(np.int64), capacity, grain, linear, quadratic)
        at = [p[0] for p in placed]
        whole_crc = rows["ids_crc32"].to_numpy(np.int64)
        full = rows["length"].to_numpy(np.int64)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].iloc[at].reset_index(drop=True),
                "start": [int(starts[r]) + s for r, s, *_ in placed],
                "length": [n for _, _, n, _, _ in placed],
                "ids_crc32": [int(whole_crc[r]) if n == full[r] else _checksum(grains.iloc[r], s, n, grain) for r, s, n, _, _ in placed],
                "doc_tokens": rows["doc_tokens"].iloc[at].reset_index(drop=True),
                "sequence_id": [2 * (int(key[0]) << 24 | k) + 1 for _, _, _, k, _ in placed],
                "offset": [o for *_, o in placed],
            }
        )

    packed = (
        tails.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(pack, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )
    full = whole.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (2 * F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)


def op4_cost_balanced_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
