"""Near-duplicate detection by min-max hashing (operator 11).

A text's set holds its distinct shingles of `words` words, A-Z lower-cased, as XXH64 numbers. Each of `permutations` random permutations
of the numbers is applied once to the set, and both the least and the greatest image are kept: a signature of two values for one evaluation. Either value is equal in two
texts with the probability of their sets' Jaccard similarity, and as the two lean away from each other, the share of equal values estimates it with a smaller variance than as
many minima of their own permutations would.

Values are taken `rows` at a time; each such band is a key. Two texts of similarity J share no key with probability (1 - J ** rows) ** bands: 3e-8
for J = 0.8 with 24 bands of 3 values out of 36 permutations. Texts with equal sets are one from the start. Texts that share a key are candidates: a
pair is left out only where the sizes of the sets, or the numbers of shingles by the last bits of their hashes, show that it can't be similar. Keys of many texts are
cut into blocks, and no list of a key's pairs is made: links between texts that are together already are skipped.
Each group of candidates is then verified on the whole sets, and components are taken over verified links.

Sets are written once, to the shared folder, with a number for each row; only those of candidates, told by a bitmap of bounded size, are shuffled.

Cases: texts without words have an empty set and are linked with nothing. Texts of fewer words than a shingle are one shingle. Equal texts and repeated
rows share a component. component_id is the smallest id reachable, null ids aside (null if all are); of a null id kept is false. A row is kept by its
id, so repeated rows are kept together. Ties cannot arise: labels are minima. Very long texts are hashed whole, a slab of shingles at a time. An empty table gives an empty result. Columns other than the
id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.bpe import slabs
from concord.llm.simhash_dedup import blocked_self_join, components, profile, shingle_hashes, verified_sets
from concord.session import cut_lineage, shared_path

BANDS, ROWS, PERMUTATIONS = 24, 3, 36
_RANDOM = np.random.default_rng(11).integers(0, 1 << 63, size=(2, 1024), dtype=np.uint64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
SLAB = 1 << 13
TEXT_SLAB = 1 << 20
MOST_MAPS = 4096


def minmax_signature(distinct: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """For each permutation the least and the greatest image of the numbers, of which there is at least one, side by side."""
    flip, factor = _RANDOM[0, :permutations, None], _RANDOM[1, :permutations, None] << np.uint64(1) | np.uint64(1)
    least, most = np.full(permutations, ~np.uint64(0)), np.zeros(permutations, dtype=np.uint64)
    for at in range(0, len(distinct), SLAB):
        image = (distinct[None, at : at + SLAB] ^ flip) * factor
        image ^= image >> np.uint64(32)
        np.minimum(least, image.min(axis=1), out=least)
        np.maximum(most, image.max(axis=1), out=most)
    return np.stack([least, most], axis=1).reshape(-1)


def estimated_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal values of two signatures."""
    return float((a == b).mean())


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A number for each band of `rows` values; it also tells the band."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for part in signature[: bands * rows].reshape(bands, rows).T:
        keys = (keys ^ part) * _MIX
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def signed_sets(docs: DataFrame, words: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """row (a number), doc_id, size, digest (two numbers), keys, profile and shingles of each row of docs, written to the shared folder and read from there."""
    permutations = -(-bands * rows // 2)

    def signed(row: int, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        sets = [np.unique(shingle_hashes(t, words)) for t in texts]
        digests = np.array([np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64) for s in sets]).reshape(-1, 2)
        keys = [band_keys(minmax_signature(s, permutations), bands, rows) if len(s) else [] for s in sets]
        columns = [pa.array(np.arange(row, row + len(sets))), ids, pa.array([len(s) for s in sets], type=pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
        columns += [pa.array(keys, type=pa.list_(pa.int64())), pa.array([profile(s).tobytes() for s in sets], type=pa.binary()), pa.array([s.view(np.int64) for s in sets], type=pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "size", "d1", "d2", "keys", "profile", "shingles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = (TaskContext.get().partitionId()) << 40
        for b in batches:
            at = 0
            for texts in slabs((t.as_py() or "" for t in b.column(1)), TEXT_SLAB):
                yield signed(row, b.column(0).slice(at, len(texts)), texts)
                at, row = at + len(texts), row + len(texts)

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(picked.mapInArrow(run, f"row long, doc_id {picked.schema['doc_id'].dataType.simpleString()}, size long, d1 long, d2 long, keys array<long>, profile binary, shingles array<long>"), "minmax-sets")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, of which later steps read the columns that they need."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def maybe_in(rows: DataFrame, some: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose key is among the `count` keys of some, and a few others: a bitmap of hashes, eight bits a key and MOST_MAPS * 4 KB at most, goes to all tasks.

    Beyond some 20 million keys the bitmap fills up and leaves less and less out. What follows must join in any case; this saves it from shuffling most other rows."""
    maps = min(MOST_MAPS, max(1, count // 4096))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(maps * 32768))
    at, bit = (place(key) / 32768).cast("int"), F.pmod(place(key), F.lit(32768)).cast("int")
    maps_of = some.select(at.alias("__at"), bit.alias("__bit")).groupBy("__at").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    byte = F.conv(F.hex(F.substring("__map", (F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumns({"__at": at, "__bit": bit}).join(F.broadcast(maps_of), "__at")
    return met.where(F.pmod((byte / F.pow(F.lit(2), F.col("__bit") % 8)).cast("int"), F.lit(2)) == 1).select(*rows.columns)


def minmax_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the row has the smallest id of its component) of every row.

    Texts are linked whose sets of shingles have a Jaccard similarity of `similarity` or more; components are those of the links."""
    # Both sides of a join grow with the corpus, so those that carry much are planned as a shuffle at any size.
    marked = signed_sets(docs, words, bands, rows, id_col, text_col)
    filled = marked.where("size > 0")
    # One row stands for each distinct set; its own number is its name.
    first = cut_lineage(filled.groupBy("d1", "d2").agg(F.min("row").alias("name"), F.min("doc_id").alias("first_id")))
    texts = stored(filled.withColumnRenamed("row", "name").select("name", "size", "keys", "profile").join(first.select("name").hint("merge"), "name", "left_semi"), "minmax-texts")
    near = components(blocked_self_join(texts, similarity)).withColumnRenamed("node", "name")
    asked = cut_lineage(near.join(near.groupBy("label").agg(F.count("*").alias("n")), "label"))
    count = asked.count()
    held = maybe_in(marked.select(F.col("row").alias("name"), "shingles"), asked, "name", count).join(asked.hint("merge"), "name").select("name", "label", "n", "shingles")
    same = components(verified_sets(held, max(1, count // 512), similarity)).withColumnRenamed("node", "name").withColumnRenamed("label", "component")
    grouped = first.join(same, "name", "left").select("d1", "d2", "first_id", F.coalesce("component", "name").alias("component"))
    smallest = cut_lineage(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")))
    of_set = cut_lineage(grouped.join(smallest, "component").select("d1", "d2", "component_id"))
    met = marked.select("doc_id", "size", "d1", "d2").join(of_set, ["d1", "d2"], "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return met.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def op11_minmax_hashing(spark, sf_dir: str) -> DataFrame:
    return minmax_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
